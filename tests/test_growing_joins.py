"""Sides of joins that grow with the input are not broadcast, however small Spark takes them."""

import math
import random

import pytest
from pyspark.sql import functions as F
from test_around import _joined

from geolist.operators import grid, neighbourhood, spatial
from geolist.plans.queries import QUERIES
from geolist.sources import scratch


def broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")


def places(spark, n, name="point_id"):
    spread = lambda by: (F.col("id") * F.lit(by)) % 1 * 0.05
    return spark.range(n).select(F.col("id").alias(name), (spread(0.618) + 48).alias("lat"), (spread(0.7548) + 9).alias("lon"))


def test_counts_and_nearest_around(spark):
    elements = places(spark, 300, "n").withColumn("tags", F.create_map(F.lit("shop"), F.lit("bakery")))
    near = neighbourhood.tag("shop") == "bakery"
    got = neighbourhood.counts_around(places(spark, 20), elements, {"n": (near, 900.0)}, nearest={"d": (near, 900.0)})
    assert broadcasts(got) == 0 and got.agg(F.sum("n"), F.count("d")).first()[0] > 20


def test_extra_scores(spark):
    assert broadcasts(QUERIES["extra_scores"](spark, "/root/testdata/sf0.001")) == 0


@pytest.mark.parametrize("name", ["radius_counts", "living_standard"])
def test_radius_sums(spark, name):
    assert broadcasts(QUERIES[name](spark, "/root/testdata/sf0.001")) == 0


def streets(n, seed):
    rng = random.Random(seed)
    rows = [(0, i, x := rng.uniform(-900, 900), y := rng.uniform(-900, 900), x + rng.uniform(-40, 40), y + rng.uniform(-40, 40), f"s{i % 7}") for i in range(n)]
    return [*rows, (0, n, *rows[5][2:6], "twin"), (0, n + 1, 4000.0, 4000.0, 4100.0, 4000.0, "far")]


COLUMNS = "city long, seg_id long, x1 double, y1 double, x2 double, y2 double, street string"


def test_nearest_segment_meets_few_and_keeps_the_rule(spark):
    """Points among many short segments, beside them, far off, on and beyond the edge of the grid."""
    rng, segs = random.Random(3), streets(1500, 4)
    spots = [(rng.uniform(-1000, 1000), rng.uniform(-1000, 1000)) for _ in range(300)] + [segs[5][2:4], (1300.0, 0.0), (2500.0, 0.0), (4100.5, 4030.0), (5100.0, 5100.0), (-4900.0, -4900.0), (7500.0, 0.0)]
    pts = [(0, i, float(x), float(y)) for i, (x, y) in enumerate(spots)]
    got = spatial.nearest_segment(spark.createDataFrame(pts, "city long, point_id long, x double, y double"), spark.createDataFrame(segs, COLUMNS), half=5000.0, index_cell=1200.0, buffer=600.0)
    assert broadcasts(got) == 0
    cell = lambda v: math.floor((v + 5000) / 1200)
    clamp = lambda v: max(0, min(8, cell(v)))

    def dist(p, s):
        dx, dy = s[4] - s[2], s[5] - s[3]
        t = max(0, min(1, ((p[2] - s[2]) * dx + (p[3] - s[3]) * dy) / (dx * dx + dy * dy)))
        return math.hypot(p[2] - s[2] - t * dx, p[3] - s[3] - t * dy)

    def candidate(p, s):
        return all(clamp(min(s[2 + i], s[4 + i]) - 600) <= min(cell(p[2 + i]) + 1, 8) and clamp(max(s[2 + i], s[4 + i]) + 600) >= max(cell(p[2 + i]) - 1, 0) for i in (0, 1))

    want = {}
    for p in pts:
        near = [(round(dist(p, s), 6), s[1]) for s in segs if candidate(p, s)]
        if near:
            want[p[1]] = min(near)
    assert {r.point_id: (round(r.dist, 6), r.seg_id) for r in got.collect()} == want and 303 < len(want) < len(pts)
    assert _joined(got._jdf.queryExecution().executedPlan()) < len(pts) * len(segs) / 20


def test_street_density(spark):
    rng, segs = random.Random(5), spark.createDataFrame(streets(400, 6), COLUMNS)
    own = spark.createDataFrame([(0, i, rng.uniform(-1000, 1000), rng.uniform(-1000, 1000)) for i in range(200)], "city long, element_id long, x double, y double")
    got = grid.street_density(own, segs)
    assert got._jdf.queryExecution().analyzed().toString().count("strategy=merge") >= 2
    assert got.agg(F.sum("amenities")).first()[0] == 200


def test_transit_access(spark):
    stops = places(spark, 40, "stop").withColumns({c: F.lit(1) for c in ("total", "peak_am", "peak_pm")})
    got = spatial.transit_access(places(spark, 30), stops, radius=800.0)
    assert broadcasts(got) == 0 and got.count() == 30


def test_geometry_pairs_meet_once(spark):
    """A line of one segment meets a point in one cell only, and lines of several segments come together."""
    rng = random.Random(8)
    spot = lambda: (48 + rng.random() * 0.03, 9 + rng.random() * 0.04)
    step = lambda p: (p[0] + rng.uniform(-0.006, 0.006), p[1] + rng.uniform(-0.009, 0.009))
    lines = [(i, [p := spot(), step(p)] if i % 4 else [spot()]) for i in range(120)]
    bent = [(200, [p := spot(), q := step(p), step(q), p]), (201, []), (202, [(48.01, 9.0), (48.01, 9.04), (48.02, 9.04)])]
    pts = [(i, *spot()) for i in range(40)]
    schema = "line_id long, geometry array<struct<lat: double, lon: double>>"

    def dist(p, line):
        local = [((b - p[2]) * 111_320 * math.cos(math.radians(p[1])), (a - p[1]) * 111_320) for a, b in line]
        out = []
        for (x, y), (z, w) in zip(local, local[1:] or local):
            dx, dy = z - x, w - y
            t = max(0, min(1, -(x * dx + y * dy) / (dx * dx + dy * dy))) if dx or dy else 0
            out.append(math.hypot(x + t * dx, y + t * dy))
        return min(out, default=math.inf)

    def near(some):
        df = spatial.geometry_pairs(spark.createDataFrame(pts, "point_id long, lat double, lon double"), spark.createDataFrame(some, schema), 700.0)
        got = {(r.point_id, r.line_id): round(r.dist, 6) for r in df.collect()}
        assert got == {(p[0], i): round(d, 6) for p in pts for i, line in some if (d := dist(p, line)) <= 700}
        return len(got), _joined(df._jdf.queryExecution().executedPlan())

    rows, met = near(lines)
    assert rows == met > 300
    assert near(lines + bent)[0] > rows


def test_counts_around_lines(spark):
    lines = places(spark, 200, "n").withColumn("tags", F.create_map(F.lit("railway"), F.lit("rail"))).withColumn("geometry", F.array(F.struct("lat", "lon"), F.struct((F.col("lat") + 0.003).alias("lat"), F.col("lon"))))
    near = neighbourhood.tag("railway") == "rail"
    got = neighbourhood.counts_around(places(spark, 20), lines, {"n": (near, 900.0)}, nearest={"d": (near, 900.0)})
    assert broadcasts(got) == 0 and got.agg(F.sum("n"), F.count("d")).first()[0] > 20


def test_persona_training_writes_rows_not_values(spark):
    sf = "/root/testdata/sf0.001"
    before = len(scratch._MADE)
    assert QUERIES["persona_training"](spark, sf).count() == 14
    written = sum(spark.read.parquet(p).count() for p in scratch._MADE[before:])
    assert written < 6 * spark.read.parquet(f"{sf}/orders.parquet").count()
