"""Weighted multi-label learning: long features, standardisation, one logistic fit per label, evaluation."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..sources.scratch import met, shared_dir, staged
from .ranking import ranked

# Score of a rule label, threshold grid, bias of a label that never or always holds.
LABEL_SCORE = 0.55
THRESHOLDS = [round(0.10 + 0.05 * i, 2) for i in range(17)]
CERTAIN = 20.0


# Map column of a record, prefix of its features, and the keys that count (none: all).
FAMILIES: dict[str, tuple[str, tuple[str, ...]]] = {
    "listing": ("listing.", ()),
    "scores": ("osm.score.", ()),
    "metrics": ("osm.metric.", ()),
    "air": ("air.", ("uba_station_dist_m",)),
    "gtfs": ("gtfs.", ("nearest_stop_m", "stops_within_radius", "departures_within_radius_total", "departures_within_radius_peak_am", "departures_within_radius_peak_pm")),
    "noise": ("noise.", ("lden_db", "lnight_db")),
    "keywords": ("kw.", ()),
}


_ENTRIES = "array<struct<feature:string,value:double>>"


def feature_array(groups: dict[str, str]) -> Column:
    """Array of ``struct(feature, value)`` from map columns; ``groups`` maps a column to its name prefix; only finite values."""
    named = lambda c, p: F.transform(F.map_entries(F.transform_values(c, lambda _, v: v.cast("double"))), lambda e: F.struct(F.concat(F.lit(p), e.key).alias("feature"), e.value.alias("value")))
    none = F.expr(f"cast(array() as {_ENTRIES})")
    every = F.concat(*[F.coalesce(named(c, p), none) for c, p in groups.items()])
    return F.filter(every, lambda e: e.value.isNotNull() & ~F.isnan(e.value) & (F.abs(e.value) < float("inf")))


def numeric_features(df: DataFrame, key: str, groups: dict[str, str]) -> DataFrame:
    """Long ``key, feature, value`` of ``feature_array``.

    All maps are read in one pass over the rows.
    """
    return df.select(key, F.explode(feature_array(groups)).alias("e")).select(key, "e.feature", "e.value")


def with_features(records: DataFrame, *, price_percentile: str = "price_pct", confidence: str = "confidence") -> DataFrame:
    """Add ``features``, the array of all features of a record: the maps of ``FAMILIES`` that are there, price percentile and confidence.

    Of listing fields only numeric ones (``*_num``) count; an unknown or zero confidence is a half.
    """
    here = {c: f for c, f in FAMILIES.items() if c in records.columns}

    def counted(c: str, keys: tuple[str, ...]) -> Column:
        if c == "listing":
            return F.map_filter(c, lambda k, _: k.endswith("_num"))
        return F.map_filter(c, lambda k, _: k.isin(*keys)) if keys else F.col(c)

    ready = {f"_{c}": counted(c, keys) for c, (_, keys) in here.items()}
    known = F.coalesce(F.when(F.col(confidence) != 0, F.col(confidence)), F.lit(0.5))
    extra = F.create_map(F.lit("listing.price_m2_pct_in_city"), F.col(price_percentile).cast("double"), F.lit("geo.confidence_0_1"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), known.cast("double"))))
    every = feature_array({f"_{c}": p for c, (p, _) in here.items()} | {"_extra": ""})
    return records.withColumns(ready | {"_extra": extra}).withColumn("features", every).drop(*ready, "_extra")


def assemble_features(records: DataFrame, key: str, *, price_percentile: str = "price_pct", confidence: str = "confidence") -> DataFrame:
    """All features of records, long; see ``with_features``."""
    made = with_features(records, price_percentile=price_percentile, confidence=confidence)
    return made.select(key, F.explode("features").alias("e")).select(key, "e.feature", "e.value")


def feature_index(features: DataFrame) -> DataFrame:
    """``feature, i`` of all distinct names in their order, from 0; names are numbered by sorted ranges."""
    return ranked(staged(features.select("feature").distinct()), [], ["feature"], "i").select("feature", F.col("i").cast("int").alias("i"))


def sparse_vectors(features: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """``key, indices, values``: the features that a row has, by rising number; all others are 0."""
    numbered = features.join(index, "feature").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", "value"))).alias("e"))
    return numbered.select(key, F.col("e.i").alias("indices"), F.col("e.value").alias("values"))


def dense(indices: Column, values: Column, size: int) -> Column:
    """Array of ``size`` values with zeros where a sparse vector has none."""
    at = F.map_from_arrays(indices, values)
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at(at, i), F.lit(0.0)))


def feature_scale(features: DataFrame, rows: int) -> DataFrame:
    """``feature, mean, std, varies`` over ``rows`` rows of which ``features`` holds the values that are there; missing ones are 0.

    Population deviation, 1 where a feature does not vary.
    """
    own = features.groupBy("feature").agg(F.count("*").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v"))
    share = F.col("n") / F.lit(rows)
    spread = F.sqrt(F.greatest(F.lit(0.0), share * (F.col("v") + F.col("m") * F.col("m") * (1 - share))))
    return own.select("feature", (share * F.col("m")).alias("mean"), F.when(spread >= 1e-9, spread).otherwise(1.0).alias("std"), (spread >= 1e-9).alias("varies"))


def vector_table(features: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """``key, vector`` as ``SparseVector`` of the features that a row has; the table is written once, in the form of vectors."""
    size = index.count()
    parts = sparse_vectors(features, index, key).select(key, F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"), F.col("indices").cast("array<int>").alias("indices"), "values").alias("vector"))
    path = shared_dir(features.sparkSession)
    parts.write.parquet(path)
    schema = StructType([parts.schema[key], StructField("vector", VectorUDT())])
    return features.sparkSession.read.schema(schema).parquet(path)


@dataclass
class SparseModel:
    """Weights of one label for raw feature values by name, and the bias that stands for what a zero contributes."""

    label: str
    weights: dict[str, float]
    bias: float


def fit_sparse(features: DataFrame, labels: DataFrame, names: list[str], *, key: str = "id", weight: str = "weight", l2: float = 1.0, iterations: int = 200, min_rows: int = 10) -> list[SparseModel]:
    """``fit_rows`` over long ``features(key, feature, value)`` and ``labels(key, weight, <names>)``, the training rows."""
    own = features.groupBy(key).agg(F.collect_list(F.struct("feature", "value")).alias("features"))
    rows = met(labels.select(key, weight, *names), own, key, "left").withColumn("features", F.coalesce("features", F.expr(f"cast(array() as {_ENTRIES})")))
    return fit_rows(staged(rows.drop(key)), names, weight=weight, l2=l2, iterations=iterations, min_rows=min_rows)


def fit_rows(rows: DataFrame, names: list[str], *, weight: str = "weight", l2: float = 1.0, iterations: int = 200, min_rows: int = 10) -> list[SparseModel]:
    """One weighted L2 logistic regression per label of ``names`` over the training ``rows(weight, <names>, features)``.

    ``features`` is an array of ``struct(feature, value)``, so rows stay whole: no table of single values is shuffled
    or written.  ``rows`` must be a written table.  Vectors stay sparse: they are divided by the deviation only, and as
    the bias is free, moving the mean changes nothing but the bias, which is set right afterwards.  The penalty is on
    the weights of standardised features.  Labels that never or always hold get a fixed bias, features that do not vary no weight.
    """
    total = rows.agg(F.count("*").alias("n"), F.sum(weight).alias("w"), *[F.avg(F.col(c).cast("double")).alias(c) for c in names]).first()
    if total.n < min_rows:
        raise ValueError(f"{total.n} training rows are too few")
    each = rows.select(F.explode("features").alias("e")).select("e.feature", "e.value")
    scale = staged(feature_scale(each, total.n).where("varies"))
    known = [(r.feature, r["std"]) for r in feature_index(scale).join(scale, "feature").orderBy("i").select("feature", "std").collect()]
    spread = F.from_json(F.lit(json.dumps({f: {"i": i, "std": s} for i, (f, s) in enumerate(known)})), "map<string,struct<i:int,std:double>>")
    placed = F.transform("features", lambda e: F.struct(F.try_element_at(spread, e.feature).alias("s"), e.value.alias("value")))
    placed = F.array_sort(F.transform(F.filter(placed, lambda e: e.s.isNotNull()), lambda e: F.struct(e.s.i.alias("i"), (e.value / e.s.std).alias("value"))))
    vector = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(len(known)).alias("size"), F.col("placed.i").alias("indices"), F.col("placed.value").alias("values"))
    made = rows.select(F.col(weight).cast("double").alias(weight), *[F.col(c).cast("double").alias(c) for c in names], placed.alias("placed")).select(weight, *names, vector.alias("vector"))
    path = shared_dir(rows.sparkSession)
    made.write.option("compression", "zstd").parquet(path)
    ready = rows.sparkSession.read.schema(StructType([*made.schema.fields[:-1], StructField("vector", VectorUDT())])).parquet(path)
    models = []
    for c in names:
        share = total[c] or 0.0
        if share in (0.0, 1.0):
            models.append(SparseModel(c, {}, CERTAIN if share else -CERTAIN))
            continue
        fit = LogisticRegression(featuresCol="vector", labelCol=c, weightCol=weight, regParam=l2 / total.w, elasticNetParam=0.0, standardization=False, maxIter=iterations, tol=1e-9).fit(ready)
        models.append(SparseModel(c, {f: float(w) / s for (f, s), w in zip(known, fit.coefficients)}, float(fit.intercept)))
    return models


def row_predictions(rows: DataFrame, models: list[SparseModel], *, key: str = "id") -> DataFrame:
    """Long ``key, label, truth, p`` for ``rows(key, <labels>, features)``, row by row."""
    def one(m: SparseModel) -> Column:
        weights = F.from_json(F.lit(json.dumps(m.weights)), "map<string,double>")
        dot = F.aggregate("features", F.lit(0.0), lambda t, e: t + e.value * F.coalesce(F.try_element_at(weights, e.feature), F.lit(0.0)))
        return F.struct(F.lit(m.label).alias("label"), F.col(m.label).cast("int").alias("truth"), (1 / (1 + F.exp(-(dot + F.lit(m.bias))))).alias("p"))

    # the outer form: the plain one adds a filter that repeats the whole expression
    return rows.select(key, F.explode_outer(F.array(*map(one, models))).alias("r")).select(key, "r.*")


def sparse_predictions(features: DataFrame, rows: DataFrame, models: list[SparseModel], *, key: str = "id") -> DataFrame:
    """Long ``key, label, truth, p`` for ``rows(key, <labels>)``: weights meet features by name, as a join."""
    spark = features.sparkSession
    weights = spark.createDataFrame([(m.label, f, w) for m in models for f, w in m.weights.items()], "label string, feature string, w double")
    dot = features.join(weights, "feature").groupBy(key, "label").agg(F.sum(F.col("value") * F.col("w")).alias("dot"))
    each = F.array(*[F.struct(F.lit(m.label).alias("label"), F.lit(m.bias).alias("bias"), F.col(m.label).cast("int").alias("truth")) for m in models])
    asked = rows.select(key, F.explode(each).alias("r")).select(key, "r.*")
    p = 1 / (1 + F.exp(-(F.coalesce("dot", F.lit(0.0)) + F.col("bias"))))
    return asked.join(dot, [key, "label"], "left").select(key, "label", "truth", p.alias("p"))


def weak_labels(personas: Column, *, threshold: float = LABEL_SCORE) -> Column:
    """0/1 map of labels from an array of ``persona, score``: 1 from the threshold on."""
    return F.map_from_entries(F.transform(personas, lambda p: F.struct(p.persona, (p.score >= threshold).cast("int"))))


def scale_stats(train: DataFrame, names: list[str]) -> DataFrame:
    """``feature, mean, std`` of columns over the training rows: population deviation, 1 where a column does not vary."""
    value = lambda n: F.coalesce(F.col(n).cast("double"), F.lit(0.0))
    row = train.agg(*[F.struct(F.lit(n).alias("feature"), F.coalesce(F.avg(value(n)), F.lit(0.0)).alias("mean"), F.stddev_pop(value(n)).alias("std")).alias(f"s{i}") for i, n in enumerate(names)])
    each = row.select(F.explode(F.array(*[f"s{i}" for i in range(len(names))])).alias("s")).select("s.*")
    return each.withColumn("std", F.when(F.col("std") >= 1e-9, F.col("std")).otherwise(1.0))


def standard_scale(train: DataFrame, names: list[str]) -> dict[str, tuple[float, float]]:
    """``scale_stats`` by name, for ``scaled``: as many rows as there are columns."""
    return {r.feature: (r["mean"], r["std"]) for r in scale_stats(train, names).collect()}


def scaled(names: list[str], scale: dict[str, tuple[float, float]]) -> Column:
    """Standardised feature array; missing values count as 0 before scaling."""
    return F.array(*[(F.coalesce(F.col(n), F.lit(0.0)) - m) / s for n, (m, s) in ((n, scale[n]) for n in names)])


def pick_labels(rows: DataFrame, manual: DataFrame, *, key: str, mode: str = "hybrid") -> DataFrame:
    """``labels`` map per row: manual where given, else the weak ones (``hybrid``); ``manual`` or ``weak`` alone otherwise."""
    own = manual.select(key, F.col("labels").alias("_m"))
    if mode == "weak":
        return rows.withColumn("labels", F.col("weak"))
    if mode == "manual":
        return rows.join(own, key).withColumnRenamed("_m", "labels")
    return rows.join(own, key, "left").withColumn("labels", F.coalesce("_m", "weak")).drop("_m")


def sample_weight(confidence: Column) -> Column:
    return F.greatest(F.lit(0.25), F.coalesce(F.when(confidence != 0, confidence), F.lit(0.5)))


@dataclass
class LabelModel:
    """Weights and bias of one label over the standardised features."""

    label: str
    weights: list[float]
    bias: float
    threshold: float = 0.5

    def probability(self, features: Column) -> Column:
        dot = F.aggregate(F.zip_with(features, F.array(*[F.lit(float(w)) for w in self.weights]), lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)
        return 1 / (1 + F.exp(-(dot + F.lit(self.bias))))


def fit_labels(train: DataFrame, labels: list[str], *, features: str = "features", weight: str = "weight", l2: float = 1.0, iterations: int = 200, min_rows: int = 10) -> list[LabelModel]:
    """One weighted L2 logistic regression per label, bias free; labels that never or always hold get a fixed bias.

    Fewer than ``min_rows`` training rows are an error.
    """
    total = train.agg(F.count("*").alias("n"), F.sum(weight).alias("w"), *[F.avg(c).alias(c) for c in labels]).first()
    if total.n < min_rows:
        raise ValueError(f"{total.n} training rows are too few")
    size = train.select(F.size(features)).first()
    width = size[0] if size else 0
    ready = train.withColumn("_x", array_to_vector(features)).select("_x", weight, *[F.col(c).cast("double").alias(c) for c in labels]).persist()
    models = []
    for c in labels:
        share = total[c] or 0.0
        if share in (0.0, 1.0):
            models.append(LabelModel(c, [0.0] * width, CERTAIN if share else -CERTAIN))
            continue
        fit = LogisticRegression(featuresCol="_x", labelCol=c, weightCol=weight, regParam=l2 / total.w, elasticNetParam=0.0, standardization=False, maxIter=iterations, tol=1e-9).fit(ready)
        models.append(LabelModel(c, [float(x) for x in fit.coefficients], float(fit.intercept)))
    ready.unpersist()
    return models


def predictions(df: DataFrame, models: list[LabelModel], *, key: str, features: str = "features") -> DataFrame:
    """Long ``key, label, truth, p`` of every model."""
    both = F.array(*[F.struct(F.lit(m.label).alias("label"), F.col(m.label).cast("int").alias("truth"), m.probability(F.col(features)).alias("p")) for m in models])
    return df.select(key, F.explode(both).alias("r")).select(key, "r.*")


def threshold_sweep(scored: DataFrame) -> DataFrame:
    """Best threshold by F1 per label over the grid, the first on ties: ``label, threshold, f1``."""
    grid = scored.select("label", "truth", "p", F.explode(F.array(*[F.lit(t) for t in THRESHOLDS])).alias("threshold"))
    hit = (F.col("p") >= F.col("threshold")).cast("int")
    sums = grid.groupBy("label", "threshold").agg(F.sum(hit * F.col("truth")).alias("tp"), F.sum(hit * (1 - F.col("truth"))).alias("fp"), F.sum((1 - hit) * F.col("truth")).alias("fn"))
    f1 = F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") > 0, 2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(0.0)
    best = F.max(F.struct(F.round(f1, 12).alias("f1"), (-F.col("threshold")).alias("t")))
    return sums.groupBy("label").agg(best.alias("b")).select("label", (-F.col("b.t")).alias("threshold"), "b.f1")


def evaluate(scored: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Precision, recall and F1 per label, with rows ``micro`` (from totals) and ``macro`` (mean)."""
    hit = (F.col("p") >= F.col("threshold")).cast("int")
    sums = scored.join(thresholds.select("label", "threshold"), "label").groupBy("label").agg(F.sum(hit * F.col("truth")).alias("tp"), F.sum(hit * (1 - F.col("truth"))).alias("fp"), F.sum((1 - hit) * F.col("truth")).alias("fn"))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)

    def rates(df: DataFrame) -> DataFrame:
        p, r = share(F.col("tp"), F.col("tp") + F.col("fp")), share(F.col("tp"), F.col("tp") + F.col("fn"))
        return df.select("label", p.alias("precision"), r.alias("recall"), share(2 * p * r, p + r).alias("f1"))

    each = rates(sums)
    micro = rates(sums.agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")]).withColumn("label", F.lit("micro")))
    macro = each.agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "f1")]).select(F.lit("macro").alias("label"), "precision", "recall", "f1")
    return each.unionByName(micro).unionByName(macro)
