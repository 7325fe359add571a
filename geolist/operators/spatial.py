"""Spatial joins by grid keys: equi-joins on cells, filtered by exact distance.  No nested-loop joins.

Cell keys spread work over the cluster; a crowded cell is one key of a plain equi-join, which adaptive
execution can split.  Only tables of a checked size are broadcast, by Spark's own threshold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import BOX_METRES_PER_DEGREE, METRES_PER_DEGREE, haversine, segment_distance, segments_of
from ..sources.scratch import met, staged


def _floor(c: Column) -> Column:
    return F.floor(c).cast("int")


def radius_pairs(points: DataFrame, elements: DataFrame, radius: float, *, keep: list[str] | None = None) -> DataFrame:
    """All ``points(point_id, lat, lon)`` with ``elements(lat, lon, ...)`` within ``radius`` metres, and ``dist``.

    Cells are ``radius`` high; a point is looked up in the cells that its radius box touches, whose width in
    degrees follows the latitude.  Rows without coordinates match nothing.
    """
    cell = radius / BOX_METRES_PER_DEGREE
    reach = F.lit(radius) / (F.lit(BOX_METRES_PER_DEGREE) * F.cos(F.radians(F.least(F.abs("lat") + F.lit(cell), F.lit(89.0)))))
    rows = F.sequence(_floor((F.col("lat") - cell) / cell), _floor((F.col("lat") + cell) / cell))
    cols = F.sequence(_floor((F.col("lon") - reach) / cell), _floor((F.col("lon") + reach) / cell))
    here = points.where("lat is not null and lon is not null").select("point_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), F.explode(rows).alias("_cy"), cols.alias("_cols"))
    here = here.select("*", F.explode("_cols").alias("_cx")).drop("_cols")
    kept = keep if keep is not None else [c for c in elements.columns if c not in ("lat", "lon")]
    there = elements.where("lat is not null and lon is not null").select(*kept, "lat", "lon", _floor(F.col("lat") / cell).alias("_cy"), _floor(F.col("lon") / cell).alias("_cx"))
    dist = haversine(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon"))
    return here.join(there, ["_cy", "_cx"]).withColumn("dist", dist).where(F.col("dist") <= radius).select("point_id", *kept, "dist")


def geometry_pairs(points: DataFrame, lines: DataFrame, radius: float, *, keep: list[str] | None = None) -> DataFrame:
    """All ``points(point_id, lat, lon)`` with ``lines(line_id, geometry, ...)`` within ``radius`` metres of any part, and ``dist``.

    ``geometry`` is an array of ``struct(lat, lon)``; one vertex is a point, none matches nothing.  Segments are laid
    into the cells of their box grown by the radius, a point is looked up once, in its own cell, so a segment meets it
    once; only lines of several segments are then brought together.  Distances are measured on a plane around the point.
    """
    kept = keep if keep is not None else [c for c in lines.columns if c != "geometry"]
    cell, tall = radius / BOX_METRES_PER_DEGREE / 2, radius / BOX_METRES_PER_DEGREE
    here = points.where("lat is not null and lon is not null").select("point_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), F.cos(F.radians("lat")).alias("_cos"), _floor(F.col("lat") / cell).alias("_cy"), _floor(F.col("lon") / cell).alias("_cx"))
    parts = F.when(F.size("geometry") == 1, F.array(F.struct(F.get("geometry", F.lit(0)).alias("a"), F.get("geometry", F.lit(0)).alias("b")))).otherwise(segments_of(F.col("geometry")))
    ends = [F.col(f"_s.{e}.{k}").alias(f"_{k}_{e}") for e in "ab" for k in ("lat", "lon")]
    there = lines.select(*kept, (F.size("geometry") > 2).alias("_many"), F.explode(parts).alias("_s")).select(*kept, "_many", *ends)
    box = {f"_{k}_{n}": f(f"_{k}_a", f"_{k}_b") for k in ("lat", "lon") for n, f in (("low", F.least), ("high", F.greatest))}
    there = there.withColumns(box | {f"_d{k}": F.col(f"_{k}_b") - F.col(f"_{k}_a") for k in ("lat", "lon")})
    wide = F.lit(tall) / F.cos(F.radians(F.least(F.greatest(F.abs("_lat_low"), F.abs("_lat_high")) + F.lit(2 * tall), F.lit(89.0))))
    grown = {"_lat_low": F.col("_lat_low") - tall, "_lat_high": F.col("_lat_high") + tall, "_lon_low": F.col("_lon_low") - wide, "_lon_high": F.col("_lon_high") + wide}
    there = there.withColumns(grown)
    span = lambda k: F.sequence(_floor(F.col(f"_{k}_low") / cell), _floor(F.col(f"_{k}_high") / cell))
    there = there.select("*", F.explode(span("lat")).alias("_cy"), span("lon").alias("_cols")).select("*", F.explode("_cols").alias("_cx")).drop("_cols")
    # a square of degrees, by the part of the segment that is nearest: its start, its end or its line
    u, v, du, dv = (F.col("_lon_a") - F.col("_lon")) * F.col("_cos"), F.col("_lat_a") - F.col("_lat"), F.col("_dlon") * F.col("_cos"), F.col("_dlat")
    along, length, across = -(u * du + v * dv), du * du + dv * dv, u * dv - v * du
    square = F.when(along <= 0, u * u + v * v).when(along >= length, (u + du) * (u + du) + (v + dv) * (v + dv)).otherwise(across * across / length)
    dist = F.sqrt(square) * F.lit(METRES_PER_DEGREE)
    near = F.col("_lat").between(F.col("_lat_low"), F.col("_lat_high")) & F.col("_lon").between(F.col("_lon_low"), F.col("_lon_high"))

    def pairs(some: DataFrame) -> DataFrame:
        return met(some, here, ["_cy", "_cx"]).where(near).select("point_id", *kept, dist.alias("dist")).where(F.col("dist") <= radius)

    return pairs(there.where("NOT _many")).unionByName(pairs(there.where("_many")).groupBy("point_id", *kept).agg(F.min("dist").alias("dist")))


def planar_cell(x: Column, y: Column, half: float, cell: float) -> tuple[Column, Column, Column]:
    """Column, row and membership of half-open planar cells over the square of ``half`` metres around a centre."""
    n = -(-2 * half // cell)
    ix, iy = _floor((x + half) / cell), _floor((y + half) / cell)
    return ix, iy, (ix >= 0) & (iy >= 0) & (ix < int(n)) & (iy < int(n))


def _segment_cell(segments: DataFrame, points: int, widest: float) -> float:
    """Of ``widest`` halved again and again, the cell that lays out and compares the fewest rows for so many points."""
    sizes = [widest / 2**k for k in range(10)]
    cells = lambda s: reduce(lambda a, b: a * b, [F.abs(F.col(f"{c}2") - F.col(f"{c}1")) / s + 3 for c in "xy"])
    own = lambda s: F.approx_count_distinct(F.hash("city", *[F.floor((F.col(f"{c}1") + F.col(f"{c}2")) / 2 / s) for c in "xy"]))
    told = segments.agg(*[F.sum(cells(s)).alias(f"rows{k}") for k, s in enumerate(sizes)], *[own(s).alias(f"cells{k}") for k, s in enumerate(sizes)]).first()
    cost = lambda k: (told[f"rows{k}"] or 0.0) * (1 + points / max(1, told[f"cells{k}"]))
    return sizes[min(range(len(sizes)), key=cost)]


def nearest_segment(points: DataFrame, segments: DataFrame, *, half: float, index_cell: float, buffer: float) -> DataFrame:
    """Nearest of ``segments(city, seg_id, x1, y1, x2, y2, ...)`` for each of ``points(city, point_id, x, y)``.

    A segment is a candidate if its box, grown by ``buffer`` and clamped into the index grid, touches the 3 x 3
    index cells around the point: its cells are grown by one on each side, and a point is looked up once, in its
    own cell.  Ties go to the lowest ``seg_id``.  Returns ``city, point_id, seg_id, dist``; points without a
    candidate are absent.

    All segments within ``index_cell + buffer`` metres of a point on the grid are candidates.  So rounds of smaller cells,
    sized by the density, come first: in a round of cell size s every segment within s of a point is met, a point
    whose best is no farther is settled, and only the others go on, at last to the rule itself.
    """
    n = int(-(-2 * half // index_cell))
    key = ["city", "point_id"]
    lines = staged(segments.select("city", "seg_id", "x1", "y1", "x2", "y2"))
    on_grid = reduce(lambda a, b: a & b, [_floor((F.col(a) + half) / index_cell).between(-1, n) for a in "xy"])
    left = staged(points.where(on_grid).select(*key, "x", "y"))

    def best(size: float, spans: list[Column]) -> DataFrame:
        laid = lines.select("*", F.explode(spans[0]).alias("_cx"), spans[1].alias("_ys"))
        laid = laid.select(*lines.columns, "_cx", F.explode("_ys").alias("_cy"))
        here = left.select(*key, "x", "y", *[_floor((F.col(a) + half) / size).alias(f"_c{a}") for a in "xy"])
        d = segment_distance(F.col("x"), F.col("y"), F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
        first = F.min(F.struct(d.alias("dist"), F.col("seg_id").alias("seg_id")))
        return met(here, laid, ["city", "_cx", "_cy"]).groupBy(*key).agg(first.alias("b")).select(*key, "b.seg_id", "b.dist")

    size, settled = _segment_cell(lines, left.count(), index_cell), []
    while size < index_cell:
        near = best(size, [F.sequence(_floor((F.least(f"{a}1", f"{a}2") + half) / size - 1), _floor((F.greatest(f"{a}1", f"{a}2") + half) / size + 1)) for a in "xy"])
        settled.append(staged(near.where(F.col("dist") <= size - 1e-3)))
        left = staged(met(left, settled[-1].select(*key), key, "left_anti"))
        if left.isEmpty():
            return reduce(DataFrame.unionByName, settled)
        size *= 4
    clamp = lambda c: F.least(F.lit(n - 1), F.greatest(F.lit(0), _floor((c + half) / index_cell)))
    rule = best(index_cell, [F.sequence(clamp(F.least(f"{a}1", f"{a}2") - buffer) - 1, clamp(F.greatest(f"{a}1", f"{a}2") + buffer) + 1) for a in "xy"])
    return reduce(DataFrame.unionByName, settled, rule)


def transit_access(points: DataFrame, stops: DataFrame, *, radius: float, cell_deg: float = 0.01) -> DataFrame:
    """Stops near ``points(point_id, lat, lon)``: nearest in the touched cell block, counts and departures in the radius.

    ``stops`` have ``lat, lon, total, peak_am, peak_pm``.  The nearest stop may lie outside the radius, as the
    block is looked at whole; it is null where the block is empty.
    """
    dlat = radius / BOX_METRES_PER_DEGREE
    dlon = F.lit(radius) / F.greatest(F.lit(1.0), F.lit(BOX_METRES_PER_DEGREE) * F.cos(F.radians("lat")))
    rows = F.sequence(_floor((F.col("lat") - dlat) / cell_deg), _floor((F.col("lat") + dlat) / cell_deg))
    cols = F.sequence(_floor((F.col("lon") - dlon) / cell_deg), _floor((F.col("lon") + dlon) / cell_deg))
    here = points.select("point_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), F.explode(rows).alias("_cy"), cols.alias("_cols"))
    here = here.select("point_id", "_lat", "_lon", "_cy", F.explode("_cols").alias("_cx"))
    there = stops.select("lat", "lon", "total", "peak_am", "peak_pm", _floor(F.col("lat") / cell_deg).alias("_cy"), _floor(F.col("lon") / cell_deg).alias("_cx"))
    pairs = met(here, there, ["_cy", "_cx"]).withColumn("d", haversine(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon")))
    inside = F.col("d") <= radius
    sums = [F.sum(F.when(inside, F.col(c)).otherwise(0)).alias(c) for c in ("total", "peak_am", "peak_pm")]
    got = pairs.groupBy("point_id").agg(F.min("d").alias("nearest_stop_m"), F.count_if(inside).alias("stops_in_radius"), *sums)
    empty = [F.coalesce(c, F.lit(0)).alias(c) for c in ("stops_in_radius", "total", "peak_am", "peak_pm")]
    return met(points.select("point_id"), got, "point_id", "left").select("point_id", "nearest_stop_m", *empty)


def nearest_station(points: DataFrame, stations: DataFrame, *, cell_deg: float = 0.2, max_rings: int = 6, ring_rule: bool = False) -> DataFrame:
    """Nearest of ``stations(station_id, lat, lon)`` within the box of ``max_rings`` cells; ties to the lowest id.

    ``ring_rule`` looks at rings 0 to 2 and then only up to the first ring with a station.  Stations, the few, are
    laid into all cells that they serve; a point is looked up once, in its own cell.
    """
    cy, cx = _floor(F.col("lat") / cell_deg), _floor(F.col("lon") / cell_deg)
    here = points.select("point_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), cy.alias("_cy"), cx.alias("_cx"))
    side = lambda c: F.explode(F.sequence(F.col(c) - max_rings, F.col(c) + max_rings))
    there = stations.select("station_id", "lat", "lon", cy.alias("py"), cx.alias("px")).select("*", side("py").alias("_cy")).select("*", side("px").alias("_cx"))
    met = here.join(there, ["_cy", "_cx"]).withColumn("dist", haversine(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon")))
    if ring_rule:
        from pyspark.sql import Window

        met = met.withColumn("ring", F.greatest(F.abs(F.col("_cy") - F.col("py")), F.abs(F.col("_cx") - F.col("px"))))
        first = F.min("ring").over(Window.partitionBy("point_id"))
        met = met.withColumn("_first", first).where(F.col("ring") <= F.greatest(F.lit(2), F.col("_first")))
    return met.groupBy("point_id").agg(F.min(F.struct("dist", "station_id")).alias("b")).select("point_id", "b.station_id", "b.dist")


def raster_sample(points: DataFrame, cells: DataFrame, *, x0: float, y0: float, width: float, height: float, no_data: float | None = None) -> DataFrame:
    """Value of the raster cell under each of ``points(point_id, x, y)``, per band.

    ``cells(band, row, col, value)`` is the raster as a table; ``x0, y0`` its upper left corner.  No-data and NaN
    become null; points outside have null values for no band and are absent.
    """
    here = points.select("point_id", _floor((F.lit(y0) - F.col("y")) / height).alias("row"), _floor((F.col("x") - x0) / width).alias("col"))
    bad = F.isnan("value") | (F.col("value") == F.lit(no_data) if no_data is not None else F.lit(False))
    return here.join(cells, ["row", "col"]).select("point_id", "band", F.when(~bad, F.col("value")).alias("value"))


def per_location(points: DataFrame, operator, *, digits: int = 4) -> DataFrame:
    """Run ``operator(points(point_id, lat, lon))`` once per rounded coordinate and hand its result to every point."""
    at = points.withColumn("_la", F.round("lat", digits)).withColumn("_lo", F.round("lon", digits))
    places = at.select("_la", "_lo").distinct().withColumn("point_id", F.concat_ws(",", "_la", "_lo"))
    got = operator(places.select("point_id", F.col("_la").alias("lat"), F.col("_lo").alias("lon"))).withColumnRenamed("point_id", "_place")
    return at.withColumn("_place", F.concat_ws(",", "_la", "_lo")).join(got, "_place", "left").drop("_place", "_la", "_lo")
