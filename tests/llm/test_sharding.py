import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from geolist.llm import sharding


def test_law_slots_and_groups(spark, docs, doc_rows):
    got = sharding.histogram_shards(docs.selectExpr("*", "1 as shard", "2 as k1"), cell_rows=10).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted((r[0] is not None, r[0] or 0, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in doc_rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_near_equal_bytes_with_a_hot_text(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot " * 50)).otherwise(F.concat(F.col("id").cast("string"), F.repeat(F.lit("y"), (F.col("id") % 300).cast("int")))).alias("text"))
    got = sharding.histogram_shards(rows)
    sizes = [r.b for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) < 0.01 * sum(sizes) / 8 + 2 * 310
    cold = got.where("doc_id % 3 <> 0").select("doc_id", "shard")
    assert cold.count() == 4000 - 1334


def test_near_equal_bytes_with_half_the_table_one_row(spark):
    """Rows that repeat one text, half of them without an id, the others with one id."""
    one = F.when(F.col("id") % 4 == 0, F.lit(None)).when(F.col("id") % 4 == 2, F.lit(-5)).otherwise(F.col("id"))
    rows = spark.range(4000).select(one.cast("long").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit("same " * 40)).otherwise(F.concat(F.col("id").cast("string"), F.repeat(F.lit("y"), (F.col("id") % 300).cast("int")))).alias("text"))
    got = sharding.histogram_shards(rows, cell_rows=100)
    sizes = got.groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.max("slot").alias("s")).collect()
    mean = sum(r.b for r in sizes) / 8
    assert len(sizes) == 8 and sum(r.n for r in sizes) == 4000 and all(r.s == r.n - 1 for r in sizes)
    assert all(abs(r.b - mean) <= 2 * (0.002 * mean + 310) for r in sizes)
    assert got.where("doc_id is null").count() == 1000


def test_shards_are_runs_of_an_exact_sort(docs):
    """Shard borders against cumulated bytes of all rows, sorted on the driver."""
    whole = docs.select("doc_id", F.expr("octet_length(coalesce(text, '')) + 1").alias("size"), sharding._key(F.coalesce("text", F.lit(""))).alias("k1"), sharding._key(F.col("doc_id")).alias("k2"), F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("c"))
    rows = sorted((r.k1, r.k2, r.size, r.doc_id, r.c) for r in whole.where("doc_id is not null or length(text) > 5").fillna(-1, ["doc_id"]).collect())
    found = {(-1 if r.doc_id is None else r.doc_id, r.text_crc32): r.shard for r in sharding.histogram_shards(docs.where("doc_id is not null or length(text) > 5"), 4, tolerance=0.01).collect()}
    order = [found[i, c] for _, _, _, i, c in rows]
    assert order == sorted(order)
    total, below = sum(r[2] for r in rows), 0
    biggest = max(r[2] for r in rows)
    for (_, _, size, _, _), a, b in zip(rows, order, order[1:]):
        below += size
        for border in range(a + 1, b + 1):
            assert abs(below - total * border / 4) <= 0.01 * total / 4 + biggest


def test_small_texts_stay_together(spark):
    rows = spark.range(20000).select(F.col("id").alias("doc_id"), (F.col("id") % 5000).cast("string").alias("text"))
    got = sharding.histogram_shards(rows)
    assert got.groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0


def test_empty_table(no_docs):
    assert sharding.histogram_shards(no_docs).count() == 0
