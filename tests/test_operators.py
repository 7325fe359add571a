"""Joins against brute force, plans without nested loops, restartable flows, readers and writers."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from geolist.functions import scores
from geolist.operators import grid, html, learn, neighbourhood, normalize, records, spatial
from geolist.sources import readers, writers
from geolist.streaming.dedupe import stream_new_records


def haversine(a, b, c, d):
    x = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 12742000 * math.asin(math.sqrt(min(1, x)))


def no_nested_loop(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_radius_pairs(spark):
    rng = random.Random(1)
    pts = [(i, 52 + rng.random() * 0.1, 13 + rng.random() * 0.1) for i in range(150)] + [(900, None, 1.0), (901, 60.0, -0.001)]
    els = [(i, 52 + rng.random() * 0.1, 13 + rng.random() * 0.1) for i in range(300)] + [(900, 60.0, 0.001), (901, None, None)]
    got = spatial.radius_pairs(spark.createDataFrame(pts, "point_id long, lat double, lon double"), spark.createDataFrame(els, "el long, lat double, lon double"), 800.0)
    want = {(p[0], e[0]) for p in pts for e in els if None not in (*p, *e) and haversine(p[1], p[2], e[1], e[2]) <= 800}
    assert {(r.point_id, r.el) for r in got.collect()} == want and no_nested_loop(got)


def test_nearest_segment(spark):
    rng = random.Random(2)
    segs = [(0, i, *[rng.uniform(-5500, 5500) for _ in range(4)]) for i in range(120)]
    segs.append((0, 500, *segs[3][2:]))
    pts = [(0, i, rng.uniform(-5000, 4999), rng.uniform(-5000, 4999)) for i in range(200)]
    got = spatial.nearest_segment(spark.createDataFrame(pts, "city long, point_id long, x double, y double"), spark.createDataFrame(segs, "city long, seg_id long, x1 double, y1 double, x2 double, y2 double"), half=5000.0, index_cell=1200.0, buffer=600.0)
    assert no_nested_loop(got)
    n = 9
    clamp = lambda v: max(0, min(n - 1, math.floor((v + 5000) / 1200)))

    def dist(p, s):
        dx, dy = s[4] - s[2], s[5] - s[3]
        t = max(0, min(1, ((p[2] - s[2]) * dx + (p[3] - s[3]) * dy) / (dx * dx + dy * dy)))
        return math.hypot(p[2] - s[2] - t * dx, p[3] - s[3] - t * dy)

    for r in got.collect():
        p = pts[r.point_id]
        cells = [[i for i in range(math.floor((v + 5000) / 1200) - 1, math.floor((v + 5000) / 1200) + 2) if 0 <= i < n] for v in p[2:]]
        near = [s for s in segs if any(clamp(min(s[2], s[4]) - 600) <= i <= clamp(max(s[2], s[4]) + 600) for i in cells[0]) and any(clamp(min(s[3], s[5]) - 600) <= j <= clamp(max(s[3], s[5]) + 600) for j in cells[1])]
        best = min(near, key=lambda s: (round(dist(p, s), 9), s[1]))
        assert r.seg_id == best[1]


def test_lattices(spark):
    cities = spark.range(1).withColumnRenamed("id", "city")
    assert grid.lattice(cities, half=5000.0, cell=300.0, circle=False).count() == 34 * 34
    assert grid.lattice(cities, half=5000.0, cell=300.0).count() == 873
    assert grid.sample_lattice(cities, half=3000.0, step=1500.0).count() == 25


def test_midrank_and_z(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 4.0), ("b", 7.0), (None, 3.0), ("a", None)], "g string, v double")
    got = sorted(((r.g or "", r.v or -1, r.percentile) for r in normalize.midrank_percentile(df, "g", "v").collect()), key=str)
    assert got == [("", 3.0, 0.5), ("a", -1, None), ("a", 1.0, 0.0), ("a", 2.0, 0.5), ("a", 2.0, 0.5), ("a", 4.0, 1.0), ("b", 7.0, 0.5)]
    z = {(r.g, r.v): r.z for r in normalize.z_score(spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("c", 5.0), ("c", 5.0)], "g string, v double"), "g", "v").collect()}
    assert z == {("a", 1.0): -1.0, ("a", 2.0): 0.0, ("a", 3.0): 1.0, ("c", 5.0): 0.0}


def test_rank_personas_keeps_order_on_ties(spark):
    arr = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(n).alias("persona"), F.lit(s).alias("score"), F.array(F.lit("x")).alias("top_factors")) for i, (n, s) in enumerate([("b", 0.5), ("a", 0.5), ("c", 0.9), ("d", 0.1)])])
    top = spark.range(1).select(scores.rank_personas(arr, k=3).alias("t")).first().t
    assert [p.persona for p in top] == ["c", "b", "a"]


def test_stop_departures_pass_midnight(spark):
    stops = spark.createDataFrame([("f", "s"), ("f", "none")], "feed string, stop_id string")
    times = spark.createDataFrame([("f", "s", "25:10:00", None), ("f", "s", "07:00:00", None), ("f", "s", "09:00:00", None), ("f", "s", "", "31:00:00"), ("f", "s", "7:61", None), ("f", "other", "08:00:00", None)], "feed string, stop_id string, departure_time string, arrival_time string")
    got = {r.stop_id: (r.total, r.peak_am, r.peak_pm) for r in neighbourhood.stop_departures(stops, times).collect()}
    assert got == {"s": (4, 2, 0), "none": (0, 0, 0)}


PAGE = """<html><head><title>A  Flat</title><script type="application/ld+json">{"@graph":[{"@type":"RealEstateListing","name":"N","offers":[{"price":"5"}],"image":["i1"]},{"@type":"WebPage","@id":"w"}]}</script></head>
<body><h1>Nice &amp; big</h1><dl><dt>Zimmer</dt><dd>3</dd></dl><dl><dt>Zimmer</dt><dd>4</dd></dl><dl><dt>Wohnfläche ca.</dt><dd>70 m²</dd></dl>
<span class="chip">Balkon</span><span class="chip">Aufzug</span><span class="chip">Balkon</span><a href="/b?x=1">l</a><img src="/i.png"><img src="data:x"><h2>Kosten</h2><ul><li>Preis: 10</li></ul><p id="ort">Mitte</p></body></html>"""


def test_listing_records(spark):
    pages = spark.createDataFrame([(1, "https://x.de/expose/12", PAGE), (2, "https://x.de/", None), (3, "u", "<h1>Ich bin kein Roboter</h1>")], "page_id long, url string, html string")
    a, b, c = html.listing_records(pages, fields={"ort": ("id", "ort")}).orderBy("page_id").collect()
    assert (a.expose_id, a.name, a.attributes, a.features, a.documents) == ("12", "Nice & big", {"zimmer": "3", "wohnflache_ca": "70 m²"}, ["Aufzug", "Balkon"], ["https://x.de/b?x=1"])
    assert [i.url for i in a.images] == ["https://x.de/i.png"] and a.marked == {"ort": "Mitte"}
    assert (a.ld.ld_listing_name, a.ld.ld_offer_price, a.ld.ld_webpage_url, a.ld.ld_images) == ("N", "5", "w", ["i1"])
    assert b.name is None and b.features is None and not b.challenge and c.challenge


def test_titles_cut_inside_a_reference(spark):
    pages = [(1, "<title>a &amp; b&amp</title>"), (2, "<title>&quot;c&quo</title>"), (3, "<title>&lt x &copy;&#65;&#65</title>"), (4, '<title>\ue000&</title><script type="application/ld+json">{"a":"&amp &"}</script><a href="?a=1&copy=2&amp;b=3">')]
    got = {r.page_id: r for r in html.walk_pages(spark.createDataFrame(pages, "page_id long, html string")).collect()}
    assert [got[i].title for i in (1, 2, 3, 4)] == ["a & b&amp", '"c&quo', "&lt x ©A&#65", "\ue000&"]
    assert got[4].jsonld == ['{"a":"&amp &"}'] and got[4].links == ["?a=1&copy=2&b=3"]


def test_records_of_cut_headings(spark):
    pages = [(1, "https://x.de/", "<title>t</title><h1>a &amp; b&amp</h1>"), (2, "https://x.de/", '<title>c&quot</title><div class="ad">d&am</div>'), (3, "https://x.de/", "<h1>ich bin kein roboter&lt</h1>")]
    rows = html.listing_records(spark.createDataFrame(pages, "page_id long, url string, html string"), fields={"intro": ("class", "ad")}).collect()
    got = {r.page_id: (r.name, r.marked.get("intro"), r.challenge) for r in rows}
    assert got == {1: ("a & b&amp", None, False), 2: ("c&quot", "d&am", False), 3: ("ich bin kein roboter&lt", None, False)}


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a":1}\n\nbroken\n[1]\n{"a":2}\n')
    assert readers.read_jsonl(spark, str(tmp_path / "a.jsonl")).count() == 2
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.json").write_text('[{"k":1},{"k":2}]')
    (tmp_path / "b" / "failed.json").write_text('[{"k":3}]')
    assert readers.read_json_batches(spark, str(tmp_path / "b"), "k int").count() == 2
    (tmp_path / "c.json").write_text('{"items":[{"url":"u1","html":"h"},{"url":"u2","html":"cut')
    assert readers.read_broken_items(spark, str(tmp_path / "c.json")).count() == 1
    (tmp_path / "d.tsv").write_text("# c\nMünchen\t48.1\t11.5\n")
    assert readers.read_cities(spark, str(tmp_path / "d.tsv")).first().name == "München"
    df = spark.range(5).select("id", (F.col("id") / 3).alias("v"))
    writers.write_csv(df, str(tmp_path / "csv"), {"id": "", "v": "%.2f"})
    assert sorted(r.v for r in spark.read.csv(str(tmp_path / "csv"), header=True).collect()) == ["0.00", "0.33", "0.67", "1.00", "1.33"]
    routed = df.withColumn("route", F.when(F.col("id") > 2, "good").otherwise("failed"))
    assert writers.write_routes(routed, str(tmp_path / "r")) == {"seen": 5, "good": 2, "failed": 3, "skipped": 0}
    writers.write_jsonl(df, str(tmp_path / "j"), records_per_file=2)
    assert spark.read.json(str(tmp_path / "j")).count() == 5


def test_repaired_json_and_labels(spark):
    assert spark.createDataFrame([('{"a":"x\x01y"}',)], "t string").select(F.to_json(readers.parse_repaired(F.col("t"))).alias("j")).first().j == json.dumps({"a": "x y"}, separators=(",", ":"))
    rows = spark.createDataFrame([("1", {"p": 1, "q": 0}, None, 1), ("1", None, ["q"], 2), ("2", None, None, 3)], "expose_id string, labels map<string,int>, positive_personas array<string>, line_no long")
    assert [(r.expose_id, r.labels) for r in readers.label_records(rows, ["p", "q"]).collect()] == [("1", {"p": 0, "q": 1})]


def test_map_extract(spark, tmp_path):
    import bz2

    xml = "<osm><node id='1' lat='1.0' lon='2.0'/><node id='2' lat='3.0' lon='4.0'><tag k='amenity' v='a&amp;b'/></node><way id='9'><nd ref='1'/><nd ref='2'/><nd ref='7'/><tag k='highway' v='primary'/></way></osm>"
    (tmp_path / "m.osm.bz2").write_bytes(bz2.compress(xml.encode()))
    nodes, ways = readers.read_osm_xml(spark, str(tmp_path / "m.osm.bz2"))
    assert {r.node_id: r.tags for r in nodes.collect()} == {1: {}, 2: {"amenity": "a&b"}}
    line = grid.way_lines(ways.select("way_id", F.posexplode("nodes").alias("pos", "node_id")), nodes).first()
    assert [(p.lat, p.lon) for p in line.geometry] == [(1.0, 2.0), (3.0, 4.0)] and (line.lat, line.lon) == (2.0, 3.0)


def test_field_profile(spark):
    rows = spark.createDataFrame([('{"a": 1, "b": "xy", "c": [1, 2], "d": null}',), ('{"a": "z", "b": "x"}',), ("bad",)], "j string")
    got = {r.field: (r["count"], r.types, r.max_str_len, r.max_list_len) for r in records.field_profile(rows, "j").collect()}
    assert got["a"] == (2, "int,str", 1, None) and got["b"] == (2, "str", 2, None) and got["c"] == (1, "list", None, 2) and got["d"][0] == 0


def test_stream_runs_twice_like_once(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/?ref=1", "x"), (2, "http://a/", "x"), (3, "http://b/", None)], "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream_new_records(spark, str(tmp_path / "in"), "page_id long, url string, html string", str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_fit_labels(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        x = [rng.gauss(0, 1), rng.gauss(0, 1)]
        rows.append((i, x, int(x[0] > 0.1), 1, 0, 1.0))
    df = spark.createDataFrame(rows, "id long, features array<double>, a int, b int, c int, weight double")
    models = learn.fit_labels(df, ["a", "b", "c"])
    assert [m.bias for m in models[1:]] == [20.0, -20.0]
    scored = learn.predictions(df, models, key="id")
    best = {r.label: (r.threshold, r.f1) for r in learn.threshold_sweep(scored).collect()}
    assert best["a"][1] > 0.95 and best["b"] == (pytest.approx(0.1), 1.0)
    assert {r.label for r in learn.evaluate(scored, learn.threshold_sweep(scored)).collect()} == {"a", "b", "c", "micro", "macro"}


def test_broken_items_go_on_at_the_next_brace(spark, tmp_path):
    good = {"id": 1, "a": [{"b": 1}, {"c": 2}], "t": "x } y"}
    (tmp_path / "a.json").write_text('{"items": [' + json.dumps(good) + ', {"id": 2, "bad": nope}, {"other": "first"}, {"id": 3, "cut": "o', encoding="utf-8")
    (tmp_path / "b.json").write_text('{"items": []}', encoding="utf-8")
    got = readers.read_broken_items(spark, str(tmp_path)).select("pos", F.to_json("record").alias("r")).orderBy("pos").collect()
    assert [json.loads(r.r) for r in got] == [good, {"other": "first"}]


def test_timetables_and_files(spark, tmp_path):
    for feed, rows in (("north", "s1,1.5\n"), ("south", "s1,2.5\ns2,3.5\n")):
        (tmp_path / feed).mkdir()
        (tmp_path / feed / "stops.txt").write_text("\ufeffstop_id,stop_lat\n" + rows, encoding="utf-8")
    got = readers.read_gtfs(spark, str(tmp_path), "stops")
    assert {(r.feed, r.stop_id, r.stop_lat) for r in got.collect()} == {("north", "s1", "1.5"), ("south", "s1", "2.5"), ("south", "s2", "3.5")}
    import os

    os.utime(tmp_path / "north" / "stops.txt", (1, 1))
    assert readers.newest_run(spark, f"{tmp_path}/*/*.txt").endswith("/south")
    assert readers.find_files(spark, f"{tmp_path}/*/*.txt").count() == 2


def test_run_grouping(spark, tmp_path):
    lines = [("run_b_0001.jsonl", i, json.dumps({"i": i})) for i in range(5)] + [("run_b_0001.jsonl", 5, "{broken"), ("run_b_0001.jsonl", 6, " "), ("run_b_failed.jsonl", 0, '{"i": 9}'), ("notes.jsonl", 0, '{"i": 7}')]
    df = spark.createDataFrame(lines, "file_name string, line_no int, value string")
    seen = writers.write_by_run(df, str(tmp_path / "run"), constant="run")
    assert seen == {"records": 7, "decode_errors": 1}
    back = {(str(r.folder), str(r.name)) for r in spark.read.text(str(tmp_path / "run")).select("folder", "name").distinct().collect()}
    assert back == {("b", "0001"), ("b", "failed"), ("None", "notes")}
    rows = writers.grouped_lines(df, naming="flat", constant="run", max_records=2).where("record is not null")
    assert {(r.name, r["count"]) for r in rows.groupBy("name").count().collect()} == {("b_0001", 2), ("b_failed", 1), ("notes", 1)}
    assert {r.name for r in writers.grouped_lines(df, naming="original").select("name").distinct().collect()} == {"run_b_0001", "run_b_failed", "notes"}


def test_slim_counters_and_copies(spark, tmp_path):
    df = spark.createDataFrame([("7", 1.5)], "expose_id string, lat double")
    assert writers.slim(df).columns == list(writers.SLIM) and writers.slim(df).first().url is None
    for run in ("a", "b"):
        writers.write_counters(spark.createDataFrame([(3, 1)], "seen long, updated long"), str(tmp_path / "runs"), run)
    assert {(r.run, r.seen) for r in spark.read.parquet(str(tmp_path / "runs")).collect()} == {("a", 3), ("b", 3)}
    writers.write_compressed_copy(df, str(tmp_path / "copy"))
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 1


def test_compressed_lines(spark, tmp_path):
    import zstandard

    (tmp_path / "x.jsonl.zst").write_bytes(zstandard.ZstdCompressor().compress(b'{"a": 1}\n\nnope\n[1]\n{"a": 2}\n'))
    got = readers.read_jsonl(spark, str(tmp_path / "x.jsonl.zst")).select(F.variant_get("record", "$.a", "int").alias("a")).collect()
    assert sorted(r.a for r in got) == [1, 2]


def test_too_few_training_rows(spark):
    few = spark.createDataFrame([([1.0], 1.0, i % 2) for i in range(9)], "features array<double>, weight double, y int")
    with pytest.raises(ValueError):
        learn.fit_labels(few, ["y"])


def test_geometry_pairs(spark):
    rng = random.Random(7)
    pts = [(i, 52 + rng.random() * 0.05, 13 + rng.random() * 0.05) for i in range(60)] + [(900, None, 1.0)]
    lines = [(i, [(52 + rng.random() * 0.05, 13 + rng.random() * 0.05) for _ in range(i % 4)]) for i in range(40)]
    got = spatial.geometry_pairs(spark.createDataFrame(pts, "point_id long, lat double, lon double"), spark.createDataFrame(lines, "line_id long, geometry array<struct<lat:double,lon:double>>"), 700.0)
    want = set()
    for p, lat, lon in pts[:-1]:
        flat = lambda v: ((v[1] - lon) * 111320 * math.cos(math.radians(lat)), (v[0] - lat) * 111320)  # noqa: B023, E731
        for i, g in lines:
            xy = [flat(v) for v in g]
            for (x1, y1), (x2, y2) in zip(xy, xy[1:]) if len(xy) > 1 else [(v, v) for v in xy]:
                dx, dy = x2 - x1, y2 - y1
                t = max(0, min(1, -(x1 * dx + y1 * dy) / (dx * dx + dy * dy))) if dx or dy else 0
                if math.hypot(x1 + t * dx, y1 + t * dy) <= 700:
                    want.add((p, i))
    assert {(r.point_id, r.line_id) for r in got.collect()} == want and len(want) > 50 and no_nested_loop(got)


def test_cells_by_area_and_mode():
    assert grid.cell_side(side=300.0) == 300.0 and grid.cell_side(side=300.0, area=10_000.0) == 100.0
    assert grid.area_mode(radius_km=5) == (5000.0, True) and grid.area_mode(half_km=2) == (2000.0, False)
    for bad in (lambda: grid.cell_side(side=0.0), lambda: grid.area_mode(half_km=0)):
        with pytest.raises(ValueError):
            bad()
