"""Record flows: routes, joins by key, link tables, restart sets, field profiles and run counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import chunk_prefix, contains_any, is_digits, is_error_body, is_redirect_page, nested, run_of_prefix
from ..sources.scratch import staged


def first_seen(df: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key: a map-side maximum, no sort of whole groups."""
    whole = F.struct(F.col(order).alias("_o"), *[F.col(c).alias(c) for c in df.columns if c != key])
    return df.groupBy(key).agg(F.max(whole).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in df.columns if c != key])


def attach_scores(records: DataFrame, scores: DataFrame, *, key: str, order: str, payload: str, stored_hash: str | None = None, new_hash: str | None = None) -> DataFrame:
    """Left join of the last score row per key; ``outcome`` is updated, skipped (same source hash) or missing."""
    last = last_wins(scores.select(key, order, payload), key, order).select(F.col(key).alias("_k"), F.col(payload).alias("_p"))
    same = F.col(stored_hash).eqNullSafe(F.lit(new_hash)) if stored_hash else F.lit(False)
    outcome = F.when(F.col("_k").isNull(), "missing").when(same, "skipped").otherwise("updated")
    return records.join(last, F.col(key) == F.col("_k"), "left").withColumn("outcome", outcome).withColumn(payload, F.when(F.col("outcome") == "updated", F.col("_p"))).drop("_k", "_p")


def run_counters(df: DataFrame, outcome: str = "outcome") -> DataFrame:
    """One row of counters: seen, updated, skipped, missing."""
    return df.agg(F.count("*").alias("seen"), *[F.count_if(F.col(outcome) == o).alias(o) for o in ("updated", "skipped", "missing")])


def route(html: Column, has_jsonld: Column, deactivated: Column, challenge: Column) -> Column:
    """good, failed or skipped for a fetched page."""
    empty = is_error_body(html) | (F.trim(html) == "")
    return F.when(empty & F.coalesce(deactivated, F.lit(False)), "skipped").when(empty & F.coalesce(has_jsonld, F.lit(False)), "good").when(empty, "failed").when(is_redirect_page(html), "skipped").when(F.coalesce(challenge, F.lit(False)), "failed").otherwise("good")


def pending(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs whose key is not done yet."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def pending_by_version(inputs: DataFrame, stored: DataFrame, *, key: str, version: str, current: int) -> DataFrame:
    """Inputs not stored yet or stored under an older version."""
    return pending(inputs, stored.where(F.col(version) >= current), key)


def to_reprocess(failed: DataFrame, good: DataFrame, key: str) -> DataFrame:
    """Keys that failed and never succeeded since."""
    return failed.select(key).subtract(good.select(key))


def keep_or_replace(existing: str, new: str, *, force: bool = False) -> Column:
    """The stored enrichment unless there is none or ``force``."""
    return F.col(new) if force else F.coalesce(existing, new)


def cached_results(requests: DataFrame, cache: DataFrame, compute, *, key: str) -> tuple[DataFrame, DataFrame]:
    """Results of all requests and the new cache rows: only keys that the cache lacks are computed."""
    fresh = compute(requests.join(cache.select(key), key, "left_anti").dropDuplicates([key]))
    return requests.join(cache.unionByName(fresh), key), fresh


def stored_results(requests: DataFrame, path: str, compute, *, key: str, version: str) -> DataFrame:
    """Results of all requests from the stored table at ``path``, after computing what it lacks for this data ``version``.

    The table is parted by version and by the set of keys that a run computed; a run writes its part by dynamic
    overwrite, so a run that was cut off is repeated into the same part and the other parts stay as they are.  Only keys
    without a result of this version are computed, each once; a new version computes all, and older results stay
    for whoever still asks for them.  ``compute`` gets the distinct missing requests and returns ``key`` and its results.
    """
    spark = requests.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = lambda: folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    stored = lambda: spark.read.parquet(path).where(F.col("data_version") == version).drop("data_version", "run")
    missing = requests.where(F.col(key).isNotNull())
    if there():
        missing = missing.join(stored().select(key), key, "left_anti")
    missing = staged(missing.dropDuplicates([key]))
    asked = missing.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(key)).alias("h")).first()
    if asked.n:
        fresh = compute(missing).withColumn("data_version", F.lit(version)).withColumn("run", F.lit(f"{asked.n}-{asked.h & (2**64 - 1):016x}"))
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("data_version", "run").parquet(path)
    return requests.join(stored(), key, "left") if there() else requests


def place_key(lat: Column, lon: Column, *radii: float, digits: int = 4) -> Column:
    """Key of a request around a place: coordinates at ``digits`` decimals, and the radii."""
    return request_key(F.round(lat, digits), F.round(lon, digits), *[F.lit(float(r)) for r in radii])


def request_key(*params: Column) -> Column:
    return F.sha2(F.encode(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(params)])), "utf-8"), 256)


def infer_runs(files: DataFrame, *, name: str = "file_name", by: list[str] | None = None, constant: str = "expose_analysis") -> DataFrame:
    """The run of chunk files (per ``by``): the id of their most common prefix, the least one on ties."""
    named = files.withColumn("_p", chunk_prefix(F.col(name))).where("_p is not null")
    counts = named.groupBy(*(by or []), "_p").agg(F.count("*").alias("_n"))
    best = counts.groupBy(*(by or [])).agg(F.min(F.struct((-F.col("_n")).alias("o"), F.col("_p").alias("p"))).alias("b"))
    return best.select(*(by or []), run_of_prefix(F.col("b.p"), constant).alias("run"))


def numeric_ids(df: DataFrame, key: str) -> DataFrame:
    """Rows whose id is digits only."""
    return df.where(is_digits(F.col(key)))


def name_filter(df: DataFrame, name: str, needles: list[str], *, order: str, first: int | None = None) -> DataFrame:
    """Rows whose name contains any of the needles, the first ones in the given order if a number is asked for."""
    some = df.where(contains_any(F.col(name), needles))
    return some.orderBy(order).limit(first) if first else some


def union_links(*links: DataFrame) -> DataFrame:
    """Links of several pages, regions or buckets, each once."""
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out.distinct()


def by_name(df: DataFrame, name: str, *ties: str) -> DataFrame:
    """Rows in the order of the lower-cased name."""
    return df.orderBy(F.lower(name), *ties)


def label_pool(rows: DataFrame, labelled: DataFrame, *, key: str, k: int, seed: int = 42) -> DataFrame:
    """``k`` unlabelled rows in a draw that depends only on seed and key, sorted by key."""
    draw = F.md5(F.encode(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), "utf-8"))
    return rows.join(labelled.select(key).distinct(), key, "left_anti").orderBy(draw, key).limit(k).orderBy(key)


def reconcile(found: DataFrame, expected: DataFrame, *, group: str, url: str = "url") -> DataFrame:
    """Distinct links per group against the total that the page announced."""
    got = found.groupBy(group).agg(F.countDistinct(url).alias("found"))
    both = expected.select(group, "expected").join(got, group, "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return both.withColumn("matches", F.col("found") == F.col("expected"))


def new_per_bucket(links: DataFrame, *, bucket: str, url: str = "url") -> DataFrame:
    """Per bucket the distinct links and those not seen in an earlier bucket."""
    each = links.select(bucket, url).distinct()
    first = each.groupBy(url).agg(F.min(bucket).alias("_first"))
    return each.join(first, url).groupBy(bucket).agg(F.count("*").alias("links"), F.count_if(F.col(bucket) == F.col("_first")).alias("new_links"))


def field_profile(records: DataFrame, json: str, *, section: str = "root") -> DataFrame:
    """Per field of JSON objects: count, presence, types, longest text or list, least and greatest number.

    The section ``root`` has the top-level fields, any other those of the object under that key; presence is
    counted over all records either way.
    """
    total = records.where(F.try_parse_json(json).isNotNull()).count()
    whole = F.try_parse_json(json)
    parsed = records.select((whole if section == "root" else nested(whole, section, kind="variant")).alias("v")).where("v is not null and schema_of_variant(v) like 'OBJECT%'")
    fields = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("v").outer())).select(F.col("key").alias("field"), F.col("value").alias("x")).where("field is not null")
    kind = F.schema_of_variant("x")
    name = F.when(kind.startswith("OBJECT"), "dict").when(kind.startswith("ARRAY"), "list").when(kind == "BOOLEAN", "bool").when(kind == "BIGINT", "int").when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), "float").when(kind == "STRING", "str").otherwise("null")
    typed = fields.select("field", name.alias("kind"), F.when(name == "str", F.length(F.try_variant_get("x", "$", "string"))).alias("chars"), F.when(name == "list", F.size(F.try_variant_get("x", "$", "array<variant>"))).alias("items"), F.when(name.isin("int", "float"), F.try_variant_get("x", "$", "double")).alias("number"))
    each = typed.groupBy("field", "kind").agg(F.count("*").alias("n"), F.max("chars").alias("chars"), F.max("items").alias("items"), F.min("number").alias("low"), F.max("number").alias("high"))
    out = each.groupBy("field").agg(F.sum(F.when(F.col("kind") != "null", F.col("n")).otherwise(0)).alias("count"), F.array_sort(F.collect_list("kind")).alias("types"), F.max("chars").alias("max_str_len"), F.max("items").alias("max_list_len"), F.min("low").alias("min_num"), F.max("high").alias("max_num"))
    return out.select(F.lit(section).alias("section"), "field", "count", (100.0 * F.col("count") / F.lit(max(total, 1))).alias("presence_pct"), F.array_join("types", ",").alias("types"), "max_str_len", "max_list_len", "min_num", "max_num")


def top_reasons(df: DataFrame, reason: str, k: int = 6) -> DataFrame:
    """The ``k`` most frequent reasons, ties by name."""
    return df.groupBy(reason).agg(F.count("*").alias("n")).orderBy(F.desc("n"), reason).limit(k)
