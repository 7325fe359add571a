"""Group-relative normalisation that survives one huge group: ranks run over distinct values, not rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import staged
from .ranking import running


def midrank_percentile(df: DataFrame, group: str, value: str, name: str = "percentile") -> DataFrame:
    """Add the mid-rank percentile of ``value`` in its group, in [0, 1]; one value gives 0.5, null stays null.

    Values are counted per group first; how many rows of the group lie below a value is a running sum over sorted
    ranges, so a group of any number of distinct values spreads over all tasks.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(group).alias("_g"), F.col(value).alias("_v")).agg(F.count("*").alias("_k"))
    counts = staged(counts)
    sizes = counts.groupBy(F.col("_g").alias("_h")).agg(F.sum("_k").alias("_n"))
    ranked = running(counts, ["_g"], ["_v"], {"_lo": "_k"}).join(sizes, F.col("_g").eqNullSafe(F.col("_h")))
    middle = (2 * F.col("_lo") + F.col("_k") - 1) / 2 / (F.col("_n") - 1)
    ranked = ranked.select("_g", "_v", F.when(F.col("_n") <= 1, 0.5).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), middle))).alias(name))
    return df.join(ranked, F.col(group).eqNullSafe(F.col("_g")) & (F.col(value) == F.col("_v")), "left").drop("_g", "_v")


def group_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """``n, mean, std`` per group (sample deviation, 0 for fewer than two values)."""
    return df.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std"))


def z_score(df: DataFrame, group: str, value: str, name: str = "z") -> DataFrame:
    """Add the z-score of ``value`` in its group; 0 where the group does not vary."""
    stats = group_stats(df, group, value).withColumnRenamed(group, "_g")
    z = F.when(F.col("std") <= 1e-9, 0.0).otherwise((F.col(value) - F.col("mean")) / F.col("std"))
    return df.join(stats, F.col(group).eqNullSafe(F.col("_g")), "left").withColumn(name, F.when(F.col(value).isNotNull(), z)).drop("_g", "n", "mean", "std")


def city_key(*sources):
    """Group key from the first source that names a city: trimmed and lower-cased."""
    trimmed = [F.when(F.trim(s) != "", F.lower(F.trim(s))) for s in sources]
    return F.coalesce(*trimmed)
