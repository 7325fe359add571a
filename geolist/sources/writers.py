"""Writers: chunked JSON lines, grouped JSON, CSV with fixed formats, split outputs, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.text import chunk_index, chunk_prefix
from .scratch import staged


def write_jsonl(df: DataFrame, path: str, *, records_per_file: int = 1000, compression: str = "none") -> None:
    df.write.option("maxRecordsPerFile", records_per_file).option("compression", compression).json(path)


def numbered_chunks(df: DataFrame, order: list[str], *, records_per_file: int = 1000) -> DataFrame:
    """Add ``chunk`` (from 1) and ``place`` (from 0): the rows in ``order``, cut every ``records_per_file`` over all partitions.

    ``df`` must be a written table.
    """
    from ..operators.ranking import ranked

    placed = ranked(df, [], order, "place")
    return placed.withColumn("chunk", (F.floor(F.col("place") / records_per_file) + 1).cast("long"))


def write_chunks(df: DataFrame, path: str, run: str, order: list[str], *, records_per_file: int = 1000) -> int:
    """Write ``df`` as JSON lines in files ``<run>_0001.jsonl``, ... of exactly ``records_per_file`` records (the last may be shorter).

    Records are numbered in ``order`` by sorted ranges.  Each chunk is written whole by one task and then given its
    name, which moves no data; returns the number of files.  An empty table gives no file.
    """
    spark = df.sparkSession
    columns = df.columns
    chunks = numbered_chunks(staged(df), order, records_per_file=records_per_file)
    lines = chunks.select("chunk", "place", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))
    drafts = f"{path}/_drafts"
    lines.repartition("chunk").sortWithinPartitions("chunk", "place").select("chunk", "value").write.partitionBy("chunk").text(drafts)
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    made = 0
    for status in fs.globStatus(hadoop.Path(f"{drafts}/chunk=*/part-*")) or []:
        number = int(status.getPath().getParent().getName().split("=")[1])
        if not fs.rename(status.getPath(), hadoop.Path(f"{path}/{run}_{number:04d}.jsonl")):
            raise OSError(f"chunk {number} could not be named")
        made += 1
    fs.delete(hadoop.Path(drafts), True)
    return made


def grouped_lines(lines: DataFrame, *, value: str = "value", file_name: str = "file_name", naming: str = "run", constant: str = "", max_records: int | None = None) -> DataFrame:
    """JSON lines with the folder and file they go to: ``folder, name, record``; ``record`` is null for broken lines.

    ``naming`` is ``run`` (run folder and chunk number), ``flat`` (short file name) or ``original``; ``constant`` is
    cut from the front of names.  Of a file the first ``max_records`` good lines stay, in the order of ``line_no``.
    """
    stem = F.regexp_replace(file_name, r"\.jsonl?$", "")
    short = lambda c: F.coalesce(F.nullif(F.regexp_replace(c, f"^{constant}_?", ""), F.lit("")), c) if constant else c
    name = F.col(file_name)
    failed = F.regexp_extract(name, r"^(.+?)_?failed\.jsonl?$", 1)
    prefix = chunk_prefix(name)
    forms = {
        "run": (F.when(prefix.isNotNull(), short(prefix)).when(failed != "", short(failed)).otherwise(""), F.when(prefix.isNotNull(), chunk_index(name)).when(failed != "", "failed").otherwise(short(stem))),
        "flat": (F.lit(""), short(stem)),
        "original": (F.lit(""), stem),
    }
    folder, out = forms[naming]
    rows = lines.where(F.trim(value) != "").select(*[c for c in lines.columns if c != value], folder.alias("folder"), out.alias("name"), F.try_parse_json(value).alias("record"))
    if max_records is not None:
        nth = F.count_if(F.col("record").isNotNull()).over(Window.partitionBy(file_name).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0))
        rows = rows.withColumn("_n", nth).where(F.col("_n") <= max_records).drop("_n")
    return rows


def write_by_run(lines: DataFrame, path: str, **options) -> dict[str, int]:
    """Write ``grouped_lines`` as JSON under ``folder=/name=``; returns the numbers of records and of broken lines."""
    seen = Observation()
    rows = grouped_lines(lines, **options).observe(seen, F.count("record").alias("records"), F.count_if(F.col("record").isNull()).alias("decode_errors"))
    rows.where("record is not null").select("folder", "name", F.to_json("record").alias("value")).write.partitionBy("folder", "name").text(path)
    return dict(seen.get)


# Columns of the slim table of scores.
SLIM = ("expose_id", "url", "address", "lat", "lon", "geocode_method", "geocode_precision", "living_standard_score_0_100", "amenities_score_0_1", "transit_score_0_1", "green_score_0_1", "nightlife_score_0_1", "traffic_score_0_1", "amenity_total", "transit_total", "green_total", "major_road_ways", "major_road_maxspeed_kmh_avg")


def slim(df: DataFrame) -> DataFrame:
    """The slim columns in their order; those that are missing are null."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in SLIM])


def formatted(df: DataFrame, formats: dict[str, str]) -> DataFrame:
    """Columns in the given order with ``printf`` formats (an empty format keeps the value); nulls stay blank."""
    return df.select(*[F.when(F.col(c).isNotNull(), F.format_string(f, c)).alias(c) if f else F.col(c) for c, f in formats.items()])


def write_csv(df: DataFrame, path: str, formats: dict[str, str]) -> None:
    formatted(df, formats).write.option("header", True).option("emptyValue", "").csv(path)


def write_compressed_copy(df: DataFrame, path: str) -> None:
    """Raw copy as Parquet under Zstandard."""
    df.write.option("compression", "zstd").parquet(path)


def write_routes(df: DataFrame, path: str, *, route: str = "route") -> dict[str, int]:
    """One folder per route (good, failed, skipped) in a single pass over the input; returns the counts."""
    seen = Observation()
    counts = [F.count_if(F.col(route) == r).alias(r) for r in ("good", "failed", "skipped")]
    df.observe(seen, F.count("*").alias("seen"), *counts).write.partitionBy(route).parquet(path)
    return dict(seen.get)


def write_counters(counters: DataFrame, path: str, run: str) -> None:
    """Append one row of run counters."""
    counters.withColumn("run", F.lit(run)).write.mode("append").parquet(path)
