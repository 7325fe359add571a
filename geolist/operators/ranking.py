"""Sums along an order that no single task could hold: sorted ranges, totals of the ranges, offsets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..sources.scratch import staged


def _starts(batch: pa.RecordBatch, last: pa.RecordBatch | None, names: list[str]) -> np.ndarray:
    """Where a row differs from the row before in any of the named columns; null equals null."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = last is None
    for name in names:
        col = batch.column(name)
        before = pa.concat_arrays([last.column(name), col[:-1]]) if last is not None else col
        col, before = (col, before) if last is not None else (col[1:], col[:-1])
        same = pc.or_(pc.fill_null(pc.equal(col, before), False), pc.and_(pc.is_null(col), pc.is_null(before)))
        new[batch.num_rows - len(col) :] |= ~np.asarray(same)
    return new


def running(df: DataFrame, group: list[str], order: list[str | Column], sums: dict[str, str] | None = None, xors: dict[str, str] | None = None) -> DataFrame:
    """Add, for each ``name: column`` of ``sums`` (of ``xors``), the sum (the exclusive or) of that long column over
    the rows that come before in the row's ``group``.

    The rows are sorted into ranges of ``(group, order)``, each range is passed once, and what a group has in the
    ranges before is added from a table of the ranges' totals, which holds two rows a range at most: only the
    first and the last group of a range can reach beyond it.  So one group may hold any part of the rows, and any
    number of rows may be equal in ``order`` (these come in any order).  ``df`` must be a written table: rows are told apart by
    their place in it.  The result is a written table.  Sums must fit a long; nulls count as zero.
    """
    sums, xors = sums or {}, xors or {}
    made = {**sums, **xors}
    placed = df.withColumn("_row", F.monotonically_increasing_id())
    keys = [*[F.col(g) for g in group], *order, F.col("_row")]
    schema = StructType([*df.schema.fields, *[StructField(f"_{n}", LongType()) for n in made], StructField("_range", IntegerType())])
    fold = {**{n: np.add for n in sums}, **{n: np.bitwise_xor for n in xors}}

    columns, names = df.columns, [*df.columns, *[f"_{n}" for n in made], "_range"]

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, dict.fromkeys(made, np.int64(0))
        place = TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            heads = np.flatnonzero(_starts(batch, last, group))
            cut = np.r_[0, heads[heads > 0], batch.num_rows]
            out = [batch.column(c) for c in columns]
            for name, column in made.items():
                own = np.asarray(pc.fill_null(pc.cast(batch.column(column), pa.int64()), 0))
                before = np.empty_like(own)
                for lo, hi in zip(cut[:-1], cut[1:]):
                    start = np.int64(0) if lo in heads[:1] or lo > 0 else carried[name]
                    total = fold[name].accumulate(own[lo:hi])
                    before[lo] = start
                    before[lo + 1 : hi] = fold[name](total[:-1], start)
                    carried[name] = fold[name](total[-1], start)
                out.append(pa.array(before))
            yield pa.record_batch([*out, pa.array(np.full(batch.num_rows, place, np.int32))], names)
            last = batch.slice(batch.num_rows - 1)

    ranged = staged(placed.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(along, schema))
    totals = ranged.groupBy(*group, "_range").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()], *[F.bit_xor(c).alias(f"_t_{n}") for n, c in xors.items()])
    by = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    earlier = by.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_ranges", F.count("*").over(by)).where("_ranges > 1")
    offsets = totals.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_range").alias("_r"), *[(F.sum if n in sums else F.bit_xor)(f"_t_{n}").over(earlier).alias(f"_o_{n}") for n in made])
    same = F.col("_range") == F.col("_r")
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    own = lambda n: F.coalesce(F.col(f"_o_{n}"), F.lit(0))
    return ranged.join(F.broadcast(offsets), same, "left").select(*[F.col(f"`{c}`") for c in df.columns], *[(F.col(f"_{n}") + own(n) if n in sums else F.col(f"_{n}").bitwiseXOR(own(n))).alias(n) for n in made])


def ranked(df: DataFrame, group: list[str], order: list[str | Column], name: str = "rank") -> DataFrame:
    """Add the row's place in its group, from 0, along ``order``; see ``running``."""
    return running(df.withColumn("_one", F.lit(1).cast("long")), group, order, {name: "_one"}).drop("_one")
