"""Shared helpers: scratch tables in the cluster's shared folder, Arrow text access, connected components."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders made by this process, for ``drop_staged``.
_MADE: list[str] = []
#: The ASCII white space that separates words: blank and \x09-\x0D.
SPACES = "\x20\t\n\x0b\x0c\r"


def shared_base(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where that is unset and one machine does all work."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("geolist.local.checkpoint", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="geolist-checkpoint-")
        spark.conf.set("geolist.local.checkpoint", base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder name below ``shared_base``, noted for ``drop_staged``."""
    path = f"{shared_base(spark)}/geolist-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def drop_staged(spark: SparkSession, keep: Iterable[str] = ()) -> int:
    """Delete the folders that this process has made below the shared folder, but for those to ``keep``; returns their number.

    Results are lazy and read these folders, so call it when the results are written.
    """
    gone = [path for path in _MADE if path not in set(keep)]
    for path in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        _MADE.remove(path)
    return len(gone)


def free_since(spark: SparkSession, mark: int, *, keep: str = "") -> None:
    """Delete the tables staged since there were ``mark`` of them, but for that at ``keep``, and let go of finished shuffles.

    For tables whose last reader has been written.  Spark removes the shuffle files of a finished step when the driver
    happens to collect its garbage; this asks for it.
    """
    drop_staged(spark, keep=[*_MADE[:mark], keep])
    gc.collect()
    spark._jvm.System.gc()


def mark_staged() -> int:
    """How many staged tables there are, for ``free_since``."""
    return len(_MADE)


def staged(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = path or shared_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def light(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``df`` marked to be sent to all machines if it has at most ``rows`` (narrow) rows, else as it is."""
    return F.broadcast(df) if df.count() <= rows else df


def parts_for(df: DataFrame, text: str, bytes_each: int) -> int:
    """How many pieces of about ``bytes_each`` bytes of ``text`` the table makes (1 at least)."""
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, -(-int(total) // bytes_each))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, so that a worker holds few texts and what it makes of them at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def column_bytes(data: pa.RecordBatch | pa.Table, name: str) -> list[bytes]:
    """A string column as a list of bytes objects; null is empty."""
    col = data.column(name)
    col = pc.fill_null(pc.cast(col, pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()), b"")
    return col.to_pylist()


def column_ids(data: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    """An integer column as int64; null becomes the largest value."""
    return np.asarray(pc.fill_null(pc.cast(data.column(name), pa.int64()), np.iinfo(np.int64).max))


def words_of(text: str | Column) -> Column:
    """Words between ASCII white space, as an array; null and blank texts give an empty array."""
    blanks = F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.filter(F.split(blanks, " "), lambda w: w != "")


def crc_mod(doc_id: str, modulus: int) -> Column:
    """crc32 of the id written as decimal text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.encode(F.col(doc_id).cast("string"), "utf-8")), F.lit(modulus))


def planes(values: np.ndarray) -> bytes:
    """Eight-byte integers as byte planes: equal high bytes stand together and compress in the shuffle."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(blob: bytes, dtype: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view(dtype).ravel()


def hash_bounds(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's range of sorted unsigned hashes begins, and the end."""
    owner = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(owner, np.arange(buckets + 1, dtype=np.uint64))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges(a, b)``: rows ``(node, root)``, root the least node reachable.

    Each round gives a node the least of its label, its neighbours' labels and its label's label, and then gives
    each old label the least that any node under it has got, so that whole trees move to smaller roots: a randomly
    numbered chain of 1000 takes about 15 rounds, one of 20,000 about 20; stars are done at once.  Labels only
    fall, so the rounds end, and they go on until nothing moves.  What a round moves is a written table, so a
    lost executor costs one round.  Minima are combined before each shuffle; joins are left to adaptive
    execution, which splits hubs.
    """
    spark, mark = edges.sparkSession, mark_staged()
    both = staged(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    label = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")))
    while True:
        seen = both.join(label.select(F.col("node").alias("b"), F.col("root").alias("r")), "b").groupBy(F.col("a").alias("node")).agg(F.min("r").alias("r"))
        jump = label.select(F.col("node").alias("root"), F.col("root").alias("up"))
        path = shared_dir(spark)
        new = staged(label.join(seen, "node").join(jump, "root").select("node", F.col("root").alias("old"), F.least("root", "r", "up").alias("root")), path)
        if not new.where("root < old").limit(1).count():
            free_since(spark, mark, keep=path)
            return new.select("node", "root")
        hook = new.groupBy(F.col("old").alias("node")).agg(F.min("root").alias("h"))
        label = staged(new.join(hook, "node", "left").select("node", F.least("root", "h").alias("root")))
