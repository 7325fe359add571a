"""Registered queries on group normalisation, personas and learning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores
from ..functions.text import KEYWORDS, split_name
from ..operators import learn, normalize
from ..sources.scratch import met, staged
from .base import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_LISTED = "ls AS (SELECT o_orderkey AS id, c_nationkey::BIGINT AS city, o_totalprice::DOUBLE AS price FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as listings: price in its city."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("city"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey", F.col("o_totalprice").cast("double").alias("price"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select("id", "city", "price")


_PCT = "pc AS (SELECT id, city, price, count(*) OVER (PARTITION BY city) AS n, rank() OVER (PARTITION BY city ORDER BY price) - 1 AS lo, count(*) OVER (PARTITION BY city ORDER BY price RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi FROM ls), pp AS (SELECT id, city, price, CASE WHEN n <= 1 THEN 0.5 ELSE least(1.0, greatest(0.0, ((lo + hi - 1) / 2) / (n - 1))) END::DOUBLE AS pct FROM pc)"


@query(f"WITH {_LISTED}, {_PCT} SELECT id, city, round(pct, 6) AS percentile FROM pp")
def city_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.midrank_percentile(_listed(spark, sf_dir), "city", "price").select("id", "city", F.round("percentile", 6).alias("percentile"))


@query(f"WITH {_LISTED}, st AS (SELECT city, avg(price) AS m, coalesce(stddev_samp(price), 0) AS s FROM ls GROUP BY 1) SELECT id, ls.city, round(CASE WHEN s <= 1e-9 THEN 0 ELSE (price - m) / s END, 6) AS z FROM ls JOIN st ON ls.city IS NOT DISTINCT FROM st.city")
def city_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.z_score(_listed(spark, sf_dir), "city", "price").select("id", "city", F.round("z", 6).alias("z"))


@query(f"WITH {_LISTED} SELECT city, count(price) AS n, round(avg(price), 6) AS mean, round(coalesce(stddev_samp(price), 0), 6) AS std FROM ls GROUP BY 1")
def city_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.group_stats(_listed(spark, sf_dir), "city", "price").select("city", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


_SCORES = ("transit", "nightlife", "walk", "amenities", "safety", "family", "health", "quiet", "green_quality")


def _persona_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, Column]]:
    """Orders with derived neighbourhood scores, area, rooms, parking, text and price percentile."""
    base = normalize.midrank_percentile(_listed(spark, sf_dir), "city", "price")
    k = F.col("id")
    words = F.element_at(F.array(*[F.lit(t) for t in _TEXTS]), (k % len(_TEXTS) + 1).cast("int"))
    rows = base.select("id", "city", "percentile", *[(k * (7 + 4 * i) % 1009 / 1009.0).alias(s) for i, s in enumerate(_SCORES)], F.when(k % 10 > 0, 25.0 + k % 140).alias("area"), (1 + k % 6).cast("double").alias("rooms"), F.when(k % 4 == 0, 1.0).alias("parking"), words.alias("text"), F.when(k % 3 > 0, k % 100 / 100.0).alias("confidence"))
    factors = scores.persona_factors({s: F.col(s) for s in _SCORES}, F.col("percentile"), F.col("area"), F.col("rooms"), F.col("parking"), F.col("text"))
    return rows.select("id", "confidence", *[v.alias(f"f_{k}") for k, v in factors.items()]), {k: F.col(f"f_{k}") for k in factors}


_TEXTS = ["Student sucht WG nahe Uni und Campus", "Familie mit Kinder, Kita und Garten", "Barrierefrei mit Aufzug und Lift", "Homeoffice und Glasfaser, Arbeitszimmer", "Garage, Stellplatz, Carport", "Luxus Penthouse, exklusiv, Neubau", "ohne Angaben"]


def _factor_sql() -> dict[str, str]:
    lin = lambda x, a, b: f"coalesce(CASE WHEN {x} IS NOT NULL THEN least(1.0, greatest(0.0, ({x} - {a}) / {b - a})) END, 0.0)"
    kw = {f"kw_{k}": "least(1.0, (" + " + ".join(f"contains(lower(text), '{w}')::INT" for w in v) + f") / {float(min(5, len(v)))}::DOUBLE)" for k, v in KEYWORDS.items()}
    budget = "coalesce(least(1.0, greatest(0.0, 1 - pct)), 0.5)"
    return {s: s for s in _SCORES} | kw | {"budget": budget, "not_budget": f"(1 - {budget})", "not_quiet": "(1 - quiet)", "large_area": lin("area", 70, 140), "small_area": f"(1 - {lin('area', 35, 90)})", "more_rooms": lin("rooms", 2, 5), "parking_kw": f"least(1.0, (CASE WHEN parking > 0 THEN 1.0 ELSE 0.0 END) + 0.4 * {kw['kw_car_commuter']})"}


_F = _factor_sql()
_WEIGHT = "CASE WHEN confidence IS NULL OR confidence = 0 THEN 1.0 ELSE greatest(0.25, least(1.0, confidence)) END"


def _persona_sql(name: str) -> str:
    value = " + ".join(f"{w} * {_F[f]}" for f, w in scores.PERSONAS[name].items())
    value = f"({value}) * (1 - 0.35 * nightlife)" if name == "quiet_seeker" else value
    return f"least(1.0, greatest(0.0, {value}))::DOUBLE * {_WEIGHT}"


_PERSONAS = f"WITH {_LISTED}, {_PCT}, ro AS (SELECT id, city, pct, {', '.join(f'(id * {7 + 4 * i} % 1009) / 1009.0::DOUBLE AS {s}' for i, s in enumerate(_SCORES))}, CASE WHEN id % 10 > 0 THEN 25.0::DOUBLE + id % 140 END AS area, (1 + id % 6)::DOUBLE AS rooms, CASE WHEN id % 4 = 0 THEN 1.0 END AS parking, {_TEXTS!r}[id % {len(_TEXTS)} + 1] AS text, CASE WHEN id % 3 > 0 THEN (id % 100) / 100.0::DOUBLE END AS confidence FROM pp), ps AS (" + " UNION ALL ".join(f"SELECT id, {i} AS place, '{p}' AS persona, {_persona_sql(p)} AS score FROM ro" for i, p in enumerate(scores.PERSONAS)) + ")"


@query(f"{_PERSONAS} SELECT id, persona, round(score, 6) AS score FROM ps")
def persona_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, factors = _persona_rows(spark, sf_dir)
    # the outer form: the plain one adds a filter that repeats the whole expression
    each = rows.select("id", F.explode_outer(scores.persona_scores(factors, F.col("confidence"))).alias("p"))
    return each.select("id", "p.persona", F.round("p.score", 6).alias("score"))


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, factors = _persona_rows(spark, sf_dir)
    each = rows.select("id", scores.persona_array(factors, F.col("confidence")).alias("all"))
    return each.select("id", scores.rank_personas(F.transform("all", lambda p: F.struct(p.place.alias("place"), p.persona.alias("persona"), F.round(p.score, 9).alias("score"), p.top_factors.alias("top_factors"))), k=3, min_score=0.1).alias("top"))


@query(f"{_PERSONAS} SELECT id, persona, rank::INT AS rank, round(score, 9) AS score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, place) AS rank FROM ps WHERE round(score, 9) >= 0.1) WHERE rank <= 3")
def persona_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the outer form: the plain one adds a filter that repeats the whole expression
    each = _ranked(spark, sf_dir).select("id", F.posexplode_outer("top").alias("pos", "p")).where("pos is not null")
    return each.select("id", "p.persona", (F.col("pos") + 1).alias("rank"), F.col("p.score").alias("score"))


@query(f"{_PERSONAS} SELECT persona, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, place) AS rank FROM ps WHERE round(score, 9) >= 0.1) WHERE rank <= 3 AND round(score, 9) >= 0.55 GROUP BY 1")
def persona_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = _ranked(spark, sf_dir).select(F.explode_outer("top").alias("p")).where(F.col("p.score") >= learn.LABEL_SCORE)
    return each.groupBy(F.col("p.persona").alias("persona")).agg(F.count("*").alias("n"))


def _explained_sql() -> str:
    """Leading factors of each persona: by falling share of the score, ties in the order of the weights."""
    tops = []
    for name in scores.PERSONAS:
        parts = ", ".join(f"{{'o': -({_F[f]}) * {w}, 'i': {i}, 'f': '{f}'}}" for i, (f, w) in enumerate(scores.PERSONAS[name].items()))
        tops.append(f"WHEN '{name}' THEN array_to_string(list_transform(list_filter(list_sort([{parts}])[1:3], lambda x: x.o < 0), lambda x: x.f), ',')")
    return "CASE persona " + " ".join(tops) + " END"


@query(f"{_PERSONAS}, tp AS (SELECT id, persona, score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, place) AS k FROM ps WHERE round(score, 9) >= 0.1) WHERE k = 1) SELECT ro.id, coalesce(persona, 'unknown') AS primary_persona, round(coalesce(score, 0.0), 9) AS primary_score, {_explained_sql()} AS top_factors FROM ro LEFT JOIN tp USING (id)")
def persona_explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary persona with its leading factors."""
    first = F.get("top", F.lit(0))
    return _ranked(spark, sf_dir).select("id", F.coalesce(first["persona"], F.lit("unknown")).alias("primary_persona"), F.coalesce(F.round(first["score"], 9), F.lit(0.0)).alias("primary_score"), F.array_join(first["top_factors"], ",").alias("top_factors"))


@query("SELECT CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'val' ELSE 'test' END AS split, count(*) AS n FROM (SELECT ('0x' || sha256('7:' || doc_id)[1:4])::INT / 65535.0::DOUBLE AS u FROM documents) GROUP BY 1")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(split_name(F.col("doc_id").cast("string"), 7).alias("split")).groupBy("split").agg(F.count("*").alias("n"))


_SCORED = "sc AS (SELECT d AS id, label, truth, ((d * 37 + p) % 1000) / 1000.0::DOUBLE * 0.5 + 0.4 * truth AS p FROM (SELECT doc_id AS d, 'quality' AS label, quality AS truth, 11 AS p FROM labels UNION ALL SELECT doc_id, 'toxic', toxic, 23 FROM labels))"


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.explode(F.array(F.struct(F.lit("quality").alias("label"), F.col("quality").alias("truth"), F.lit(11).alias("o")), F.struct(F.lit("toxic").alias("label"), F.col("toxic").alias("truth"), F.lit(23).alias("o")))).alias("r"))
    return rows.select("id", "r.label", "r.truth", ((F.col("id") * 37 + F.col("r.o")) % 1000 / 1000.0 * 0.5 + 0.4 * F.col("r.truth")).alias("p"))


_SWEEP = f"WITH {_SCORED}, th AS (SELECT round(0.10 + 0.05 * i, 2)::DOUBLE AS threshold FROM range(17) r(i)), cn AS (SELECT label, threshold, sum(CASE WHEN p >= threshold AND truth = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN p >= threshold AND truth = 0 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN p < threshold AND truth = 1 THEN 1 ELSE 0 END) AS fn FROM sc, th GROUP BY 1, 2), f AS (SELECT label, threshold, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 12) AS f1 FROM cn), be AS (SELECT label, threshold, f1 FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY f1 DESC, threshold) AS rn FROM f) WHERE rn = 1)"


@query(f"{_SWEEP} SELECT label, threshold, round(f1, 6) AS f1 FROM be")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn.threshold_sweep(_scored(spark, sf_dir)).select("label", "threshold", F.round("f1", 6).alias("f1"))


_EVAL = f"{_SWEEP}, ct AS (SELECT label, sum(CASE WHEN p >= threshold AND truth = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN p >= threshold AND truth = 0 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN p < threshold AND truth = 1 THEN 1 ELSE 0 END) AS fn FROM sc JOIN be USING (label) GROUP BY 1), al AS (SELECT * FROM ct UNION ALL SELECT 'micro', sum(tp), sum(fp), sum(fn) FROM ct), ra AS (SELECT label, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS a, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS b FROM al), fi AS (SELECT label, a, b, CASE WHEN a + b > 0 THEN 2 * a * b / (a + b) ELSE 0 END AS f FROM ra)"


@query(f"{_EVAL} SELECT label, round(a, 6) AS precision, round(b, 6) AS recall, round(f, 6) AS f1 FROM (SELECT * FROM fi UNION ALL SELECT 'macro', avg(a), avg(b), avg(f) FROM fi WHERE label <> 'micro')")
def multilabel_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir)
    out = learn.evaluate(scored, learn.threshold_sweep(scored))
    return out.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


def _features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Document statistics as features beside both labels, a weight and a split."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double").alias("chars"), F.regexp_count("text", F.lit("[#*$%&]")).cast("double").alias("marks"), F.regexp_count("text", F.lit("[A-Z]")).cast("double").alias("capitals"), F.regexp_count("text", F.lit("\\n")).cast("double").alias("lines"))
    names = ["chars", "marks", "capitals", "lines"]
    l = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))  # noqa: E741
    rows = d.join(l, "doc_id").withColumn("weight", learn.sample_weight(F.col("doc_id") % 100 / 100.0)).withColumn("split", split_name(F.col("doc_id").cast("string"), 42))
    return rows, names


@query("SELECT doc_id, feature, value FROM (SELECT doc_id, n_chars::DOUBLE AS chars, doc_id % 7 AS rest FROM documents) UNPIVOT (value FOR feature IN (chars)) UNION ALL SELECT doc_id, 'kw.' || lang, 1.0 FROM documents")
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long features out of map columns."""
    maps = table(spark, sf_dir, "documents").select("doc_id", F.create_map(F.lit("chars"), F.col("n_chars").cast("double")).alias("listing"), F.create_map("lang", F.lit(1.0)).alias("words"))
    return learn.numeric_features(maps, "doc_id", {"listing": "", "words": "kw."})


def _feature_records(orders: DataFrame, *more: str) -> DataFrame:
    """Orders as records with maps of all feature families, with gaps, and ``more`` columns."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pairs = lambda **kv: F.create_map(*[x for n, v in kv.items() for x in (F.lit(n), v.cast("double"))])
    return orders.select(
        k.alias("id"),
        *more,
        pairs(price_num=F.col("o_totalprice"), rooms_num=F.when(k % 3 > 0, k % 6), rooms=k % 6).alias("listing"),
        pairs(transit=k % 101 / 101.0, quiet=c % 97 / 97.0).alias("scores"),
        pairs(shop_any=c % 40).alias("metrics"),
        F.when(k % 5 == 0, pairs(uba_station_dist_m=c % 9000, other=k)).alias("air"),
        pairs(nearest_stop_m=F.when(k % 2 == 0, c % 800), stops_within_radius=k % 9, line=k).alias("gtfs"),
        pairs(lden_db=F.when(k % 7 > 0, 40 + k % 30), height=k).alias("noise"),
        pairs(student=k % 5 / 5.0).alias("keywords"),
        F.when(k % 4 > 0, c % 100 / 100.0).alias("price_pct"),
        (c % 12 / 10.0).alias("confidence"),
    )


_FEATURES = {"listing.price_num": "o_totalprice", "listing.rooms_num": "CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 6 END", "osm.score.transit": "(o_orderkey % 101) / 101.0::DOUBLE", "osm.score.quiet": "(o_custkey % 97) / 97.0::DOUBLE", "osm.metric.shop_any": "o_custkey % 40", "air.uba_station_dist_m": "CASE WHEN o_orderkey % 5 = 0 THEN o_custkey % 9000 END", "gtfs.nearest_stop_m": "CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 800 END", "gtfs.stops_within_radius": "o_orderkey % 9", "noise.lden_db": "CASE WHEN o_orderkey % 7 > 0 THEN 40 + o_orderkey % 30 END", "kw.student": "(o_orderkey % 5) / 5.0::DOUBLE", "listing.price_m2_pct_in_city": "CASE WHEN o_orderkey % 4 > 0 THEN (o_custkey % 100) / 100.0::DOUBLE END", "geo.confidence_0_1": "least(1.0, coalesce(nullif((o_custkey % 12) / 10.0::DOUBLE, 0), 0.5))"}
_LONG = "fe AS (SELECT * FROM (" + " UNION ALL ".join(f"SELECT o_orderkey AS id, '{f}' AS feature, ({v})::DOUBLE AS value FROM orders" for f, v in _FEATURES.items()) + ") WHERE value IS NOT NULL)"


@query(f"WITH {_LONG} SELECT id, feature, round(value, 9) AS value FROM fe")
def feature_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feature families of records, long."""
    return learn.assemble_features(_feature_records(table(spark, sf_dir, "orders")), "id").select("id", "feature", F.round("value", 9).alias("value"))


@query(f"WITH {_LONG} SELECT feature, (row_number() OVER (ORDER BY feature) - 1)::INT AS i FROM (SELECT DISTINCT feature FROM fe)")
def feature_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn.feature_index(learn.assemble_features(_feature_records(table(spark, sf_dir, "orders")), "id"))


@query(f"WITH {_LONG}, ix AS (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS i FROM (SELECT DISTINCT feature FROM fe)) SELECT id, string_agg(i::VARCHAR, ',' ORDER BY i) AS indices, round(sum(value * (i + 1)), 2) AS weighted, count(*) AS n FROM fe JOIN ix USING (feature) GROUP BY 1")
def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse vectors of records over the feature index, and their product with 1, 2, 3, ... by the dense form."""
    features = learn.assemble_features(_feature_records(table(spark, sf_dir, "orders")), "id")
    vectors = learn.sparse_vectors(features, learn.feature_index(features), "id")
    dense = learn.dense(F.col("indices"), F.col("values"), len(_FEATURES))
    weighted = F.aggregate(F.zip_with(dense, F.sequence(F.lit(1), F.lit(len(_FEATURES))), lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x)
    summed = vectors.withColumn("weighted", F.round(weighted, 2)).withColumn("n", F.size("indices").cast("long"))
    return summed.select("id", F.array_join(F.transform("indices", lambda i: i.cast("string")), ",").alias("indices"), "weighted", "n")


@query(f"{_PERSONAS}, wl AS (SELECT id, persona, (score >= 0.55)::INT AS label FROM ps), ha AS (SELECT id, persona, CASE WHEN id % 10 = 3 THEN (persona = 'student')::INT ELSE label END AS label FROM wl) SELECT persona, sum(label)::BIGINT AS positive, count(*) AS n FROM ha GROUP BY 1")
def weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels from rule scores, replaced by manual ones where these are given."""
    rows, factors = _persona_rows(spark, sf_dir)
    weak = rows.select("id", scores.persona_scores(factors, F.col("confidence")).alias("p")).select("id", learn.weak_labels(F.col("p")).alias("weak"))
    names = list(scores.PERSONAS)
    manual = table(spark, sf_dir, "orders").where("o_orderkey % 10 = 3").select(F.col("o_orderkey").alias("id"), F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.lit(int(n == "student")) for n in names])).alias("labels"))
    each = learn.pick_labels(weak, manual, key="id").select(F.explode("labels").alias("persona", "label"))
    return each.groupBy("persona").agg(F.sum("label").cast("long").alias("positive"), F.count("*").alias("n"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 1 THEN 9.5 WHEN o_custkey % 90 > 0 AND o_totalprice > 0 THEN round(o_totalprice / (o_custkey % 90), 9) END::DOUBLE AS price_m2 FROM orders")
def price_per_m2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given price per square metre, else price by area where both are positive."""
    k, area = F.col("o_orderkey"), (F.col("o_custkey") % 90).cast("double")
    value = scores.price_per_m2(F.when(k % 5 == 1, 9.5).when(k % 5 == 2, 0.0), F.col("o_totalprice"), area)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(value, 9).alias("price_m2"))


@query("SELECT c_custkey, coalesce(nullif(lower(trim(CASE WHEN c_custkey % 3 = 0 THEN ' ' || c_mktsegment || ' ' WHEN c_custkey % 3 = 1 THEN '  ' END)), ''), lower(trim(c_name))) AS city FROM customer")
def city_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first source that names a city."""
    c = F.col("c_custkey")
    first = F.when(c % 3 == 0, F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))).when(c % 3 == 1, "  ")
    return table(spark, sf_dir, "customer").select("c_custkey", normalize.city_key(first, F.col("c_name")).alias("city"))


@query("SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std FROM (SELECT avg(n_chars) AS mean, stddev_pop(n_chars) AS std, 'n_chars' AS feature FROM documents WHERE ('0x' || sha256('42:' || doc_id)[1:4])::INT / 65535.0::DOUBLE < 0.8 UNION ALL SELECT avg(doc_id % 9), stddev_pop(doc_id % 9), 'rest' FROM documents WHERE ('0x' || sha256('42:' || doc_id)[1:4])::INT / 65535.0::DOUBLE < 0.8 UNION ALL SELECT 3.0, 1.0, 'flat')")
def scaler_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where(split_name(F.col("doc_id").cast("string"), 42) == "train")
    stats = learn.scale_stats(d.select("n_chars", (F.col("doc_id") % 9).alias("rest"), F.lit(3.0).alias("flat")), ["n_chars", "rest", "flat"])
    return stats.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query()
def persona_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit both labels on the train split, choose thresholds on validation, report the test split."""
    rows, names = _features(spark, sf_dir)
    train = rows.where("split = 'train'")
    ready = rows.withColumn("features", learn.scaled(names, learn.standard_scale(train, names)))
    models = learn.fit_labels(ready.where("split = 'train'"), ["quality", "toxic"], l2=1.0)
    thresholds = learn.threshold_sweep(learn.predictions(ready.where("split = 'val'"), models, key="doc_id"))
    out = learn.evaluate(learn.predictions(ready.where("split = 'test'"), models, key="doc_id"), thresholds)
    return out.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query()
def persona_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All twelve personas learnt from their rule labels on the assembled feature families, as sparse vectors.

    Thresholds are chosen on a tenth of the records, another tenth is reported.
    """
    rows, factors = _persona_rows(spark, sf_dir)
    weak = rows.select("id", "confidence", learn.weak_labels(scores.persona_scores(factors, F.col("confidence"))).alias("weak"))
    names = list(scores.PERSONAS)
    labels = weak.select("id", learn.sample_weight(F.col("confidence")).alias("weight"), F.pmod(F.xxhash64("id"), F.lit(10)).alias("part"), *[F.col("weak")[n].alias(n) for n in names])
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    both = met(orders, labels, F.col("o_orderkey") == F.col("id"))
    records = staged(learn.with_features(_feature_records(both, "weight", "part", *names)).select("id", "weight", "part", *names, "features"))
    models = learn.fit_rows(records.where("part < 8"), names)
    scored = lambda part: learn.row_predictions(records.where(F.col("part") == part), models)
    out = learn.evaluate(scored(9), staged(learn.threshold_sweep(scored(8))))
    return out.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])
