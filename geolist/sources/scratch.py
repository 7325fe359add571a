"""Intermediate tables in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

_MADE: list[str] = []


def shared_base(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where that is unset and one machine does all work."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("geolist.local.checkpoint", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="geolist-")
        spark.conf.set("geolist.local.checkpoint", base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder name below ``shared_base``."""
    path = f"{shared_base(spark)}/geolist-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_staged(spark: SparkSession) -> int:
    """Delete the folders that this process has made; results are lazy and read them, so call it when they are written."""
    gone = list(_MADE)
    for path in gone:
        delete_path(spark, path)
        _MADE.remove(path)
    return len(gone)


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, and a lost executor costs no more than the step."""
    path = shared_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def met(left: DataFrame, right: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """Join by sorted shuffles, so that no side is sent whole to the driver and every machine.

    Spark takes a table for as large as its files: packed zeros and rows still to be exploded let it broadcast many
    times its threshold.  For sides that grow with the input.
    """
    return left.join(right.hint("merge"), on, how)
