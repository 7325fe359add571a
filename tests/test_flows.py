"""Ranks of one huge group, timetables, restarts, stored results, numbered files, sparse learning."""

import glob
import json
import os
import random
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from geolist.operators import learn, normalize, records
from geolist.sources import readers, writers
from geolist.streaming.dedupe import stream_new_records


def test_midrank_of_one_huge_group(spark):
    rng = random.Random(3)
    values = [round(rng.gauss(0, 1), 2) for _ in range(4000)]
    df = spark.createDataFrame([("one", v) for v in values] + [(None, 1.0), ("two", None), ("two", 3.0)], "g string, v double").repartition(6)
    got = {(r.g, r.v): r.percentile for r in normalize.midrank_percentile(df, "g", "v").collect()}
    for v in set(values):
        lo, hi = sum(x < v for x in values), sum(x <= v for x in values)
        assert got["one", v] == pytest.approx((lo + hi - 1) / 2 / (len(values) - 1))
    assert got[None, 1.0] == 0.5 and got["two", 3.0] == 0.5 and got["two", None] is None


def feed(path, name, **tables):
    os.makedirs(path / name)
    for table, text in tables.items():
        (path / name / f"{table}.txt").write_bytes(text.encode("utf-8"))


def test_timetables_by_their_own_header(spark, tmp_path):
    feed(tmp_path, "a", stops="stop_id,stop_lat\ns1,1.5\n")
    feed(tmp_path, "b", stops="﻿stop_lat, stop_id,zone\r\n2.5,s2,z\r\n\r\n")
    feed(tmp_path, "c", stops='zone,stop_name,stop_id\n,"North, main ""hall""",s3\nq\n')
    got = readers.read_gtfs(spark, str(tmp_path), "stops", ["stop_id", "stop_lat", "zone", "gone"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("s1", "1.5", None, None, "a"), ("s2", "2.5", "z", None, "b"), ("s3", None, None, None, "c"), (None, None, "q", None, "c")], key=str)
    every = readers.read_gtfs(spark, str(tmp_path), "stops")
    assert every.columns == ["stop_id", "stop_lat", "stop_name", "zone", "feed"]
    assert every.where("feed = 'c' and stop_id = 's3'").first().stop_name == 'North, main "hall"'
    feed(tmp_path, "d", agency="agency_id\n1\n")
    with pytest.raises(ValueError, match="stops.txt in d"):
        readers.read_gtfs(spark, str(tmp_path), "stops")


def test_timetables_in_small_ranges(spark, tmp_path):
    for k in range(3):
        feed(tmp_path, f"f{k}", stop_times=("trip_id,stop_id\n" if k % 2 else "stop_id,trip_id\n") + "".join(f"{'t' if k % 2 else 's'}{i},{'s' if k % 2 else 't'}{i}\n" for i in range(2000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        rows = readers.read_gtfs(spark, str(tmp_path), "stop_times", ["stop_id", "trip_id"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 6000 and all(r.stop_id[0] == "s" and r.trip_id[0] == "t" and r.stop_id[1:] == r.trip_id[1:] for r in rows)


PAGES = "page_id long, url string, html string"


def test_stream_restarts_and_keeps_no_state(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    page = lambda i: (i, f"http://h/{i // 3}", f"body {i % 2}")
    want = {(i // 3, i % 2) for i in range(60)}
    for lo in range(0, 30, 10):
        spark.createDataFrame([page(i) for i in range(lo, lo + 10)], PAGES).coalesce(1).write.mode("append").parquet(src)
    stream_new_records(spark, src, PAGES, out, state, files_per_batch=1)
    for lo in range(30, 60, 10):
        spark.createDataFrame([page(i) for i in range(lo, lo + 10)], PAGES).coalesce(1).write.mode("append").parquet(src)
    stream_new_records(spark, src, PAGES, out, state, files_per_batch=1)
    first = spark.read.parquet(out).select("url", "html").collect()
    assert len(first) == len(want) and len(set(first)) == len(want)
    # a batch that was written but not committed is run again and gives the same records
    commits = sorted((int(os.path.basename(f)), f) for f in glob.glob(f"{state}/commits/*") if os.path.basename(f).isdigit())
    os.remove(commits[-1][1])
    crc = f"{state}/commits/.{commits[-1][0]}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    shutil.rmtree(sorted(glob.glob(f"{out}-keys/batch=*"))[-1])
    stream_new_records(spark, src, PAGES, out, state, files_per_batch=1)
    assert sorted(spark.read.parquet(out).select("url", "html").collect()) == sorted(first)
    # a lost checkpoint reads all again and adds nothing
    shutil.rmtree(state)
    stream_new_records(spark, src, PAGES, out, state)
    assert sorted(spark.read.parquet(out).select("url", "html").collect()) == sorted(first)
    assert not os.path.exists(f"{state}/state")


def test_stored_results(spark, tmp_path):
    path, calls = str(tmp_path / "cache"), []
    asked = spark.createDataFrame([(1, 48.00001, 9.0), (2, 48.00002, 9.0), (3, 50.0, 9.0)], "id long, lat double, lon double").withColumn("key", records.place_key(F.col("lat"), F.col("lon"), 800.0))

    def compute(missing):
        calls.append(missing.count())
        return missing.select("key", F.round("lat", 3).alias("value"))

    run = lambda df, version: sorted((r.id, r.value) for r in records.stored_results(df, path, compute, key="key", version=version).collect())
    assert run(asked, "v1") == [(1, 48.0), (2, 48.0), (3, 50.0)] and calls == [2]
    assert run(asked, "v1") == [(1, 48.0), (2, 48.0), (3, 50.0)] and calls == [2]
    more = asked.unionByName(asked.limit(1).selectExpr("9L AS id", "1.0D AS lat", "2.0D AS lon", "'other' AS key"))
    assert run(more, "v1")[-1] == (9, 1.0) and calls == [2, 1]
    assert run(asked, "v2") == [(1, 48.0), (2, 48.0), (3, 50.0)] and calls == [2, 1, 2]
    assert run(asked, "v1")[0] == (1, 48.0) and calls == [2, 1, 2]
    keys = lambda *r: asked.select(records.place_key(F.col("lat"), F.col("lon"), *r).alias("k")).distinct().count()
    assert keys(800.0) == 2 and asked.where("id = 1").select(records.place_key(F.col("lat"), F.col("lon"), 900.0)).first() != asked.where("id = 1").select("key").first()


def test_numbered_chunks(spark, tmp_path):
    df = spark.range(2345).select((F.lit(5000) - F.col("id")).alias("id"), F.when(F.col("id") % 3 > 0, "x").alias("v")).repartition(7)
    assert writers.write_chunks(df, str(tmp_path / "o"), "run", ["id"]) == 3
    files = sorted(os.path.basename(f) for f in glob.glob(str(tmp_path / "o" / "*.jsonl")))
    assert files == ["run_0001.jsonl", "run_0002.jsonl", "run_0003.jsonl"]
    got = [[json.loads(x) for x in open(tmp_path / "o" / f)] for f in files]
    assert [len(g) for g in got] == [1000, 1000, 345]
    ids = [r["id"] for g in got for r in g]
    assert ids == sorted(ids) and len(set(ids)) == 2345 and all("v" in r for g in got for r in g)
    assert writers.write_chunks(df.limit(0), str(tmp_path / "e"), "run", ["id"]) == 0


def newton(x, y, w, l2):
    """Weights and bias that minimise weighted log loss plus half of ``l2`` times the squared weights."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag([l2] * (x.shape[1] - 1) + [0.0])
    b = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ b))
        b -= np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (w * (p - y)) + ridge @ b)
    return b


def test_sparse_fit_against_newton(spark):
    rng = np.random.default_rng(4)
    n, names = 300, [f"f{i:02d}" for i in range(12)]
    x = rng.normal(2, 3, (n, 12)) * (rng.random((n, 12)) < 0.3)
    x[:, 5] = 7.0  # does not vary
    y = (x[:, 0] - x[:, 1] + rng.normal(0, 2, n) > 0).astype(int)
    w = rng.uniform(0.25, 1, n)
    long = [(i, names[j], float(x[i, j])) for i in range(n) for j in range(12) if x[i, j]]
    features = spark.createDataFrame(long, "id long, feature string, value double").repartition(3)
    rows = spark.createDataFrame([(i, float(w[i]), int(y[i]), 1, 0) for i in range(n)], "id long, weight double, y int, always int, never int")
    models = learn.fit_sparse(features, rows, ["y", "always", "never"], l2=1.0)
    assert [m.bias for m in models[1:]] == [20.0, -20.0]
    std = x.std(0)
    std[std < 1e-9] = 1
    want = newton((x - x.mean(0)) / std, y, w, 1.0)
    truth = 1 / (1 + np.exp(-(((x - x.mean(0)) / std) @ want[:-1] + want[-1])))
    got = {r.id: r.p for r in learn.sparse_predictions(features, rows, models).where("label = 'y'").collect()}
    assert max(abs(got[i] - truth[i]) for i in range(n)) < 1e-4
    vectors = learn.vector_table(features, learn.feature_index(features), "id")
    assert type(vectors.first().vector).__name__ == "SparseVector"
    with pytest.raises(ValueError):
        learn.fit_sparse(features, rows.limit(5), ["y"])


def test_map_extract_in_ranges_of_any_size(spark, tmp_path):
    xml = """<?xml version='1.0'?>
<osm version="0.6"><bounds minlat="1"/>
""" + "".join(f"<node id='{i}' lat='{i}.5' lon=\"-{i}.25\"" + ("/>\n" if i % 3 else f">\n <tag k='name' v='a &amp; &quot;b&quot; {i}'/><tag k=\"x\" v=\"1\"/><tag k=\"x\" v=\"2\"/></node>\n") for i in range(1, 30)) + "<way id='7'>" + "".join(f"<nd ref='{i}'/>" for i in range(1, 25)) + "<tag k='highway' v='primary'/></way><relation id='8'><member type='way' ref='7' role='outer'/><member type='node' ref='3' role=''/><tag k='type' v='multipolygon'/></relation></osm>"
    (tmp_path / "m.osm").write_text(xml)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    try:
        for size in ("128m", "900", "230"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found.append(sorted(map(str, readers.read_osm(spark, str(tmp_path / "m.osm")).collect())))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert all(f == found[0] for f in found) and len(found[0]) == 31
    records = readers.read_osm(spark, str(tmp_path / "m.osm"))
    node = readers.osm_nodes(records).where("node_id = 3").first()
    assert (node.lat, node.lon, node.tags) == (3.5, -3.25, {"name": 'a & "b" 3', "x": "2"})
    assert readers.osm_ways(records).first().nodes == list(range(1, 25))
    relation = readers.osm_relations(records).first()
    assert [tuple(m) for m in relation.members] == [("way", 7, "outer"), ("node", 3, "")] and relation.tags == {"type": "multipolygon"}


def test_image_text_of_a_marked_element(spark):
    from geolist.operators import html

    pages = spark.createDataFrame([(1, '<dd class="e"><img alt="B"></dd>'), (2, '<dd class="e">C <img></dd>'), (3, '<img class="e" alt="D">'), (4, '<dd class="e">x<p><img alt="E"><img alt="F"></p></dd>')], "i int, html string")
    got = {r.i: r.marked["e"] for r in html.walk_pages(pages, fields={"e": ("class", "e")}).collect()}
    assert got == {1: "B", 2: "C", 3: "D", 4: "E"}
