"""Restartable parsing as a stream: each record key is handled once over all runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import canonical_url, done_key
from ..sources.scratch import delete_path

#: Parts of the table of done keys.
BUCKETS = 64


def keyed(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """Add ``done_key``: canonical address and content hash."""
    sha = F.sha2(F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8"), 256)
    return pages.withColumn("done_key", done_key(canonical_url(F.col(url)), sha))


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the runs that share a checkpoint, made with it: a new checkpoint never writes over an old one's batches."""
    path = f"{checkpoint}/run-name"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        spark.createDataFrame([(uuid.uuid4().hex[:12],)], "value string").coalesce(1).write.text(path)
    return spark.read.text(path).first().value


def stream_new_records(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str, *, url: str = "url", html: str = "html", files_per_batch: int | None = None) -> None:
    """Append the records of new files whose key was not seen in any earlier run; a second run adds nothing.

    The stream keeps no state: the done keys are a table beside the sink, parted by their hash, and a batch
    drops what an anti-join finds there, part by part and without its own keys.  A batch writes a folder of its own
    in the sink, then its keys; one that is cut off at any point and run again writes both anew, so every record
    comes once.  The sink has a column ``batch``.
    """
    rows = spark.readStream.schema(schema)
    rows = (rows.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else rows).parquet(source)
    run, done = _run_id(spark, checkpoint), f"{sink}-keys"

    def handle(batch: DataFrame, number: int) -> None:
        name, session = f"{run}-{number:09d}", batch.sparkSession
        part = F.pmod(F.xxhash64("done_key"), F.lit(BUCKETS)).cast("int")
        fresh = keyed(batch, url=url, html=html).withColumn("part", part).dropDuplicates(["done_key"])
        home = session._jvm.org.apache.hadoop.fs.Path(done)
        if home.getFileSystem(session._jsc.hadoopConfiguration()).exists(home):
            known = session.read.schema("done_key string, part int, batch string").parquet(done).where(F.col("batch") != name)
            fresh = fresh.join(known.select("part", "done_key"), ["part", "done_key"], "left_anti")
        out = f"{sink}/batch={name}"
        fresh.drop("part").write.mode("overwrite").parquet(out)
        written = session.read.schema("done_key string").parquet(out).withColumn("part", part).withColumn("batch", F.lit(name))
        delete_path(session, f"{done}/batch={name}")
        written.repartition("part").write.mode("append").partitionBy("batch", "part").parquet(done)

    query = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
