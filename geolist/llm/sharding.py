"""Histogram sort into shards of near-equal bytes, with DataFrame functions only.

Rows are ordered by ``(hash of the text, hash of the id, hash of the row's place)``.  Exact byte counts below evenly spaced probe keys
are taken across all partitions, and the probes are refined inside the cells that hold a splitter until every
splitter is within the tolerance.  Then the rows are exchanged once.  Splitters are looked for between texts
first, so equal texts stay together; only a group of copies larger than the tolerance is cut, by id hash, and rows
that repeat an id and its text are cut among each other by their place in the written table of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Keys are unsigned 62-bit integers, so differences never overflow.
KEY_BITS = 62


def _key(col: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(col), 64 - KEY_BITS)


def _histogram(keys: DataFrame, cells: list[tuple[int, int, int]], key: str, probes: int) -> dict[tuple[int, int], int]:
    """Bytes by (cell number, probe number) for disjoint cells ``(low, width of a probe, number)`` of one key."""
    cell = F.lit(None).cast("int")
    probe = F.lit(None).cast("long")
    for low, width, i in cells:
        inside = (F.col(key) >= low) & (F.col(key) < low + width * probes)
        cell = F.when(inside, i).otherwise(cell)
        probe = F.when(inside, F.expr(f"({key} - {low}L) div {width}L")).otherwise(probe)
    counted = keys.select(cell.alias("c"), probe.alias("p"), "weight").where("c is not null").groupBy("c", "p").agg(F.sum("weight").alias("w"))
    return {(r.c, r.p): int(r.w) for r in counted.collect()}  # at most cells x probes rows


def splitters(keys: DataFrame, parts: int, *, tolerance: float = 0.002, probes: int = 256, names: tuple[str, ...] = ("k1", "k2", "k3")) -> list[tuple[int, ...]]:
    """``parts - 1`` boundaries over the keys ``names``: a row is above one if its keys are equal to it or come after.

    ``keys`` has the keys and the exact ``weight``.  Each round reads only counts: at most ``parts * probes`` numbers
    reach the driver.  A splitter inside a group of rows that agree in a key is looked for in the next key.
    """
    total = int(keys.agg(F.sum("weight")).first()[0] or 0)
    slack = tolerance * total / parts
    rest = lambda fixed: fixed + (0,) * (len(names) - len(fixed))
    found: dict[int, tuple[int, ...]] = {}
    # a search: splitter number -> (low, width of the cell, bytes below low, keys that are fixed)
    open_: dict[int, tuple[int, int, int, tuple]] = {i: (0, 1 << KEY_BITS, 0, ()) for i in range(1, parts)}
    while open_:
        groups: dict[tuple, list[int]] = {}
        for i, (low, width, below, fixed) in open_.items():
            groups.setdefault((fixed, low, width, below), []).append(i)
        by_fixed: dict = {}
        for g in groups:
            by_fixed.setdefault(g[0], []).append(g)
        for fixed, cells in by_fixed.items():
            source = keys
            for name, value in zip(names, fixed):
                source = source.where(F.col(name) == F.lit(value))
            last = len(fixed) == len(names) - 1
            step = {g: max(1, g[2] // probes) for g in cells}
            counts = _histogram(source, [(g[1], step[g], n) for n, g in enumerate(cells)], names[len(fixed)], probes)
            for n, g in enumerate(cells):
                _, low, _, below = g
                edges = [below]
                for p in range(probes):
                    edges.append(edges[-1] + counts.get((n, p), 0))
                for i in groups[g]:
                    goal = total * i / parts
                    best = min(range(probes + 1), key=lambda p: abs(edges[p] - goal))
                    if abs(edges[best] - goal) <= slack or (step[g] == 1 and last):
                        found[i] = rest((*fixed, low + best * step[g]))
                        del open_[i]
                        continue
                    p = next(p for p in range(probes) if edges[p + 1] >= goal)
                    if step[g] > 1:
                        open_[i] = (low + p * step[g], step[g], edges[p], fixed)
                    else:  # the rows of one key are larger than the tolerance: go on inside them
                        open_[i] = (0, 1 << KEY_BITS, edges[p], (*fixed, low + p))
    return [found[i] for i in range(1, parts)]


def _above(boundaries: list[tuple[int, ...]], names: tuple[str, ...] = ("k1", "k2", "k3")) -> Column:
    """How many boundaries lie at or below the row."""
    n = F.lit(0)
    for bound in boundaries:
        reached = F.lit(True)
        for name, value in reversed(list(zip(names, bound))):
            reached = (F.col(name) > value) | ((F.col(name) == value) & reached)
        n = n + reached.cast("int")
    return n


def histogram_shards(docs: DataFrame, shards: int = 8, *, doc_id: str = "doc_id", text: str = "text", cell_rows: int = 1_000_000, tolerance: float = 0.002) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1 (null: 1).  The law ``bytes`` holds: shard sizes differ from the
    mean by the tolerance and at most one row.  Equal texts lie in one shard, but for a group of copies larger than
    the tolerance that a shard's border meets: near-equal bytes go before whole groups there, and the group is cut
    by id hash, rows without an id or with one id by their place.  After the one exchange, rows of a shard are
    numbered from 0 through its cells: a cell is a range of text hashes cut again by id hash and by place, into as
    many ranges as the most frequent text and the most frequent row need, so that no cell holds much more than
    ``cell_rows`` rows.  ``grown_shard`` is null under this law.  Null ids and repeated rows are kept; which of equal
    rows goes where is left open.  An empty table gives no rows.  Other columns are not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    keys = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(F.encode(body, "utf-8")).alias("text_crc32"),
        _key(body).alias("k1"),
        _key(F.col(doc_id).cast("long")).alias("k2"),
    )
    # one pass over the texts; every probe round reads these few numbers only
    keys = staged(keys.withColumn("k3", _key(F.monotonically_increasing_id())))
    bounds = splitters(keys.select("k1", "k2", "k3", F.col("size").alias("weight")), shards, tolerance=tolerance)
    same = keys.groupBy("k1", "k2").agg(F.count("*").alias("n")).groupBy("k1").agg(F.sum("n").alias("n"), F.max("n").alias("same"))
    most = same.agg(F.sum("n").alias("all"), F.max("n").alias("top"), F.max("same").alias("same")).first()
    across, down, deep = (max(least, -(-(n or 0) // cell_rows)) for n, least in ((most.all, 16), (most.top, 16), (most.same, 1)))
    piece = lambda key, n: f"({key} div {(1 << KEY_BITS) // n + 1}L)"
    cell = F.expr(f"({piece('k1', across)} * {down} + {piece('k2', down)}) * {deep} + {piece('k3', deep)}")
    placed = keys.withColumn("shard", _above(bounds)).withColumn("cell", cell)
    in_cell = Window.partitionBy("shard", "cell").orderBy("k1", "k2", "k3", "doc_id", "text_crc32")
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy("shard", "cell").agg(F.count("*").alias("n")).select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = placed.withColumn("at", F.row_number().over(in_cell) - 1)
    return ranked.join(bases, ["shard", "cell"]).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("base") + F.col("at")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
