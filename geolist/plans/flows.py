"""Registered queries on record flows: attach, restart, links, profiles and the restartable stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import suggested_type
from ..operators import records
from ..sources import readers, writers
from ..sources.scratch import shared_dir, staged
from ..streaming.dedupe import stream_new_records
from .base import table
from .texts import canonical_sql

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_ATTACH = "sc AS (SELECT doc_id AS k, max(quality * 10 + toxic)::BIGINT AS p FROM labels GROUP BY 1)"


def _attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the last label of each; those without a label are missing."""
    scores = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") * 10 + F.col("toxic")).cast("long").alias("pos")).withColumn("payload", F.col("pos"))
    stored = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 5 == 0, "v1").alias("stored"))
    return records.attach_scores(stored, scores, key="doc_id", order="pos", payload="payload", stored_hash="stored", new_hash="v1")


@query(f"WITH {_ATTACH} SELECT doc_id, CASE WHEN k IS NULL THEN 'missing' WHEN doc_id % 5 = 0 THEN 'skipped' ELSE 'updated' END AS outcome, CASE WHEN doc_id % 5 > 0 THEN p END AS payload FROM documents LEFT JOIN sc ON k = doc_id")
def attach_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attached(spark, sf_dir).select("doc_id", "outcome", "payload")


@query(f"WITH {_ATTACH} SELECT count(*) AS seen, count(*) FILTER (WHERE k IS NOT NULL AND doc_id % 5 > 0) AS updated, count(*) FILTER (WHERE k IS NOT NULL AND doc_id % 5 = 0) AS skipped, count(*) FILTER (WHERE k IS NULL) AS missing FROM documents LEFT JOIN sc ON k = doc_id")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.run_counters(_attached(spark, sf_dir))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber >= 4)")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    return records.pending_by_version(table(spark, sf_dir, "orders").select("o_orderkey"), stored, key="o_orderkey", version="l_linenumber", current=4)


@query("WITH e AS (SELECT user_id || '|' || strftime(ts, '%Y-%m-%d') AS key, event_type FROM events) SELECT key FROM e WHERE event_type = 'error' EXCEPT SELECT key FROM e WHERE event_type = 'purchase'")
def reprocess_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and days with an error and no purchase."""
    e = table(spark, sf_dir, "events").select(F.concat_ws("|", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("key"), "event_type")
    return records.to_reprocess(e.where("event_type = 'error'"), e.where("event_type = 'purchase'"), "key")


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN 'old' END, 'new') AS enrichment FROM orders")
def keep_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "old").alias("old"), F.lit("new").alias("new"))
    return o.select("o_orderkey", records.keep_or_replace("old", "new").alias("enrichment"))


@query("SELECT doc_id FROM (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY md5('42:' || doc_id), doc_id LIMIT 50)")
def label_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.label_pool(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), key="doc_id", k=50)


@query("SELECT city, count(*) AS rows_, sum(CASE WHEN fresh THEN 1 ELSE 0 END)::BIGINT AS computed FROM (SELECT c_nationkey::BIGINT AS city, c_custkey % 4 <> 0 AS fresh FROM customer) GROUP BY 1")
def cached_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests against a result cache: only missing keys are computed."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("long").alias("city"), records.request_key(F.col("c_custkey"), F.lit(800)).alias("key"), "c_custkey")
    cache = c.where("c_custkey % 4 = 0").select("key", F.lit(False).alias("fresh"))
    both, _ = records.cached_results(c.select("city", "key"), cache, lambda df: df.select("key", F.lit(True).alias("fresh")), key="key")
    return both.groupBy("city").agg(F.count("*").alias("rows_"), F.count_if("fresh").alias("computed"))


@query("SELECT c_nationkey::BIGINT AS city, v AS version, count(*) AS rows_, round(sum(round((c_custkey % 500 / 100.0)::DOUBLE, 1) * 2), 6) AS total FROM customer, (VALUES ('v1'), ('v2')) t(v) GROUP BY ALL")
def stored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results around places from a stored table: computed once, found again in a second run, computed anew for new data."""
    place = (F.col("c_custkey") % 500 / 100.0).cast("double")
    asked = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("long").alias("city"), F.round(place, 1).alias("at"))
    asked = asked.withColumn("key", records.place_key(F.col("at"), F.lit(9.0), 800.0, 1000.0))
    path = shared_dir(spark)
    run = lambda version: records.stored_results(asked, path, lambda missing: missing.select("key", (F.col("at") * 2).alias("value")), key="key", version=version)
    run("v1")
    both = run("v1").withColumn("version", F.lit("v1")).unionByName(run("v2").withColumn("version", F.lit("v2")))
    return both.groupBy("city", "version").agg(F.count("*").alias("rows_"), F.round(F.sum("value"), 6).alias("total"))


@query("SELECT chunk, count(*) AS records, min(o_orderkey) AS first, max(o_orderkey) AS last FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 + 1 AS chunk FROM orders) GROUP BY 1")
def numbered_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in numbered chunks of exactly a thousand."""
    rows = staged(table(spark, sf_dir, "orders").select("o_orderkey"))
    chunks = writers.numbered_chunks(rows, ["o_orderkey"]).groupBy("chunk")
    return chunks.agg(F.count("*").alias("records"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))


@query("WITH d AS (SELECT DISTINCT l_suppkey AS grp, l_partkey FROM lineitem), p AS (SELECT grp, 'u' || l_partkey AS url, (row_number() OVER (PARTITION BY grp ORDER BY l_partkey) - 1)::INT AS pos FROM d) SELECT grp, pos, url FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY grp, pos) AS n FROM p) WHERE n = 1")
def link_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as links of their suppliers' lists, each kept where it appears first."""
    groups = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("grp")).agg(F.array_sort(F.collect_set("l_partkey")).alias("is"))
    return readers.link_pairs(groups.select("grp", F.transform("is", lambda i: F.concat(F.lit("u"), i.cast("string"))).alias("urls")), group="grp", urls="urls").select("grp", "pos", "url")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE n = 1")
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user."""
    return records.first_seen(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts"), "user_id", "ts", "event_id").select("user_id", "event_id", "event_type")


@query("WITH f AS (SELECT c_nationkey, count(DISTINCT o_custkey) AS found FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1), e AS (SELECT c_nationkey, CASE WHEN c_nationkey % 5 > 0 THEN count(*) END AS expected FROM customer GROUP BY 1) SELECT c_nationkey, expected, coalesce(found, 0) AS found, coalesce(found, 0) = expected AS matches FROM e LEFT JOIN f USING (c_nationkey)")
def crawl_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    found = table(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", F.col("o_custkey").alias("url"))
    expected = c.groupBy("c_nationkey").agg(F.count("*").alias("n")).select("c_nationkey", F.when(F.col("c_nationkey") % 5 > 0, F.col("n")).alias("expected"))
    return records.reconcile(found, expected, group="c_nationkey").select("c_nationkey", "expected", "found", "matches")


@query("WITH d AS (SELECT DISTINCT floor(l_quantity / 10)::INT AS bucket, l_partkey FROM lineitem), f AS (SELECT l_partkey, min(bucket) AS b FROM d GROUP BY 1) SELECT bucket, count(*) AS links, count(*) FILTER (WHERE bucket = b) AS new_links FROM d JOIN f USING (l_partkey) GROUP BY 1")
def bucket_new_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "lineitem").select(F.floor(F.col("l_quantity") / 10).cast("int").alias("bucket"), F.col("l_partkey").alias("url"))
    return records.new_per_bucket(links, bucket="bucket")


@query("WITH j AS (SELECT json_extract(props, '$.k') AS k FROM events) SELECT 'root' AS section, 'k' AS field, count(k) AS count, round(100.0 * count(k) / count(*), 6) AS presence_pct, 'int' AS types, min(k::DOUBLE) AS min_num, max(k::DOUBLE) AS max_num FROM j")
def field_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = records.field_profile(table(spark, sf_dir, "events").select("props"), "props")
    return p.select("section", "field", "count", F.round("presence_pct", 6).alias("presence_pct"), "types", "min_num", "max_num")


@query("SELECT event_type AS reason, count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 6")
def reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.top_reasons(table(spark, sf_dir, "events").withColumnRenamed("event_type", "reason"), "reason")


_SETS = [["list", "str"], ["bool"], ["int", "float"], ["str"], ["null"], ["int", "str"], ["dict"], ["bool", "int"]]


@query(f"WITH t AS (SELECT p_partkey, {_SETS!r}[p_partkey % {len(_SETS)} + 1] AS t FROM part) SELECT p_partkey, CASE WHEN list_has_any(t, ['dict', 'list']) THEN 'json' WHEN list_contains(t, 'bool') AND NOT list_has_any(t, ['int', 'float', 'str']) THEN 'boolean' WHEN list_has_any(t, ['int', 'float']) AND NOT list_contains(t, 'str') THEN 'numeric' WHEN list_contains(t, 'str') THEN 'text' ELSE 'unknown' END AS db_type FROM t")
def suggested_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.element_at(F.array(*[F.array(*map(F.lit, s)) for s in _SETS]), (F.col("p_partkey") % len(_SETS) + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", suggested_type(t).alias("db_type"))


_FIELDS = [("root", "key", "o_orderkey", "int"), ("root", "price", "o_totalprice", "float"), ("root", "status", "CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END", "str"), ("root", "urgent", "o_orderkey % 2 = 0", "bool"), ("root", "tags", "[o_orderstatus, o_orderpriority]", "list"), ("root", "data", "1", "dict"), ("data", "rooms", "o_custkey % 9", "int"), ("data", "note", "CASE WHEN o_custkey % 3 = 0 THEN o_orderpriority END", "str")]


def _profile_sql(section: str, field: str, value: str, kind: str) -> str:
    number = f"{value}" if kind in ("int", "float") else "NULL"
    return f"SELECT '{section}' AS section, '{field}' AS field, count({value}) AS count, round(100.0 * count({value}) / count(*), 6) AS presence_pct, '{kind}' AS types, {f'max(length({value}))' if kind == 'str' else 'NULL'}::INT AS max_str_len, {'2' if kind == 'list' else 'NULL'}::INT AS max_list_len, min({number})::DOUBLE AS min_num, max({number})::DOUBLE AS max_num FROM orders"


@query(" UNION ALL ".join(_profile_sql(*f) for f in _FIELDS))
def record_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of whole records and of their ``data`` object: presence, types, lengths and ranges."""
    made = {"root": [], "data": []}
    for section, field, value, kind in _FIELDS:
        if kind != "dict":
            made[section].append((F.array("o_orderstatus", "o_orderpriority") if kind == "list" else F.expr(value)).alias(field))
    rows = table(spark, sf_dir, "orders").select(F.to_json(F.struct(*made["root"], F.struct(*made["data"]).alias("data"))).alias("json"))
    both = records.field_profile(rows, "json").unionByName(records.field_profile(rows, "json", section="data"))
    return both.withColumn("presence_pct", F.round("presence_pct", 6))


@query("SELECT user_id, max_by(value, event_id) AS value FROM events GROUP BY 1")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.last_wins(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), "user_id", "event_id").select("user_id", "value")


@query("SELECT md5(url || '|' || sha256(coalesce(html, ''))) AS done, count(*) AS n FROM pages GROUP BY 1")
def done_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch twin of the stream on raw addresses: how often each key comes."""
    sha = F.sha2(F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8"), 256)
    return table(spark, sf_dir, "pages").select(F.md5(F.encode(F.concat_ws("|", "url", sha), "utf-8")).alias("done")).groupBy("done").agg(F.count("*").alias("n"))


@query(f"SELECT DISTINCT {canonical_sql('url')} || '|' || sha256(coalesce(html, '')) AS done_key FROM pages")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages table as a stream, run twice: each record key comes once, and the second run adds nothing."""
    work = shared_dir(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    pages.write.parquet(f"{work}/in")
    for _ in range(2):
        stream_new_records(spark, f"{work}/in", "page_id long, url string, html string", f"{work}/out", f"{work}/state")
    return spark.read.parquet(f"{work}/out").select("done_key")
