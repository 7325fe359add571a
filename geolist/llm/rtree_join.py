"""N-gram Jaccard join over an R-tree of count vectors.

The tokens of a set are hashed into groups, and a set is the point of its group counts.  What two sets have in common
is at most the sum of the coordinate minima of their points, and what a set has in common with any set of a tree
node at most the sum of its minima with the node's upper corner; nodes and points whose bound is too low for a link
are left.  What survives is verified with the sets themselves.

Random sets of one size lie on a thin shell, which no tree cuts well in many dimensions, so the root of the tree
branches by slices of the groups.  Sets that link differ in at most D tokens, D known from the smaller size; the
groups are cut into D + 1 + ``SPARE`` slices by hash, each differing token spoils one slice, so in ``1 + SPARE``
slices at least the two points are equal.  A point is put under the branch of each of its slices (the slice's counts
are the branch's name), and only points under one branch meet, in that branch's own tree.  Nearly empty slices
would be crowded; as a set can do without ``SPARE`` of its slices, they are left out wherever there are no more than that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, components, light, slices, staged
from .simhash import _linked_texts, _shared_prefixes, _shingle_set

#: Coordinates of a point, groups of a slice, slices that a set can do without.
GROUPS, FINE, SPARE = 64, 256, 2
_LANES = GROUPS // 4


def most_apart(size: int, percent: int) -> int:
    """The most tokens in which a set of ``size`` and one that is no smaller and links with it can differ."""
    return 100 * size // percent * (100 - percent) // 100


def size_bands(percent: int, largest: int) -> list[int]:
    """Lower ends of bands of sizes; sets that link are in one band or in neighbours."""
    ends = [1]
    while ends[-1] <= largest:
        ends.append(max(ends[-1] + 1, int(np.ceil(ends[-1] * (100 / percent) ** 3))))
    return ends


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slices(tokens: np.ndarray, band: int, count: int) -> np.ndarray:
    """Branch names of the slices of one band's scheme: sums of mixed group numbers, so equal for equal counts."""
    group = np.sort(tokens % np.uint64(count * FINE))
    of = (group // np.uint64(FINE)).astype(np.int64)
    filled = np.bincount(of, minlength=count)
    head = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    names = np.zeros(count, np.uint64)
    names[of[head]] = np.add.reduceat(_mix(group + np.uint64(1)), head)
    names = _mix(names + np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band))
    poor = filled < 2
    return names[~poor] if poor.sum() <= SPARE else names


def branches(tokens: np.ndarray, percent: int) -> np.ndarray:
    """The branches that a set is put under: those of its own band, and of the band below if a set there can link with it."""
    n = len(tokens)
    ends = size_bands(percent, n)
    k = int(np.searchsorted(ends, n, "right")) - 1
    out = []
    for band in (k - 1, k):
        if band < 0 or (band < k and n > 100 * (ends[k] - 1) // percent):
            continue
        apart = most_apart(ends[band + 1] - 1, percent)
        if apart:  # else only equal sets link there
            out.append(_slices(tokens, band, apart + 1 + SPARE))
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def point(tokens: np.ndarray) -> np.ndarray:
    """Counts of the tokens by group, at most 65,535 each (a cut count is kept as that and never prunes)."""
    return np.minimum(np.bincount(((tokens >> np.uint64(40)) % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS), 65_535).astype(np.uint16)


class CountTree:
    """R-tree over count vectors, loaded at once: halves along the widest coordinate down to leaves of ``fan`` points."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int, fan: int = 32):
        self.percent, self.fan = percent, fan
        self.order = self._tiled(points)
        self.points, self.sizes = points[self.order].astype(np.int64), sizes[self.order].astype(np.int64)
        self.levels = []  # from the leaves up: upper corners, least and largest sizes
        high, least, most = self.points, self.sizes, self.sizes
        while len(high) > 1:
            cut = np.arange(0, len(high), fan)
            high, least, most = np.maximum.reduceat(high, cut), np.minimum.reduceat(least, cut), np.maximum.reduceat(most, cut)
            self.levels.append((high, least, most))
        self.visited = 0

    def _tiled(self, points: np.ndarray) -> np.ndarray:
        todo, out = [np.arange(len(points))], []
        while todo:
            part = todo.pop()
            if len(part) <= self.fan:
                out.append(part)
                continue
            own = points[part]
            axis = int(np.argmax(own.max(0).astype(np.int64) - own.min(0)))
            half = max(self.fan, len(part) // 2 // self.fan * self.fan)
            part = part[np.argsort(own[:, axis], kind="stable")]
            todo += [part[half:], part[:half]]
        return np.concatenate(out) if out else np.empty(0, np.int64)

    def _reach(self, q: np.ndarray, size: int, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether a set of any size from ``least`` to ``most`` below the corner can link with the query."""
        p = self.percent
        bound = np.where((q >= 65_535).any(), np.iinfo(np.int32).max, np.minimum(q, high).sum(1))
        return ((100 + p) * bound >= p * (size + least)) & (100 * most >= p * size) & (p * least <= 100 * size)

    def near(self, q: np.ndarray, size: int, alive: np.ndarray) -> np.ndarray:
        """Places (in tree order) of the points still ``alive`` that the bound allows to link with the query."""
        q, at = q.astype(np.int64), np.array([0])
        for depth in range(len(self.levels) - 1, -1, -1):
            high, least, most = (x[at] for x in self.levels[depth])
            self.visited += len(at)
            at = at[self._reach(q, size, high, least, most)]
            below = len(self.levels[depth - 1][0]) if depth else len(self.points)
            at = (at[:, None] * self.fan + np.arange(self.fan)).ravel()
            at = at[at < below]
        at = at[alive[at]]
        self.visited += len(at)
        return at[self._reach(q, size, self.points[at], self.sizes[at], self.sizes[at])]


def spanning(points: np.ndarray, sizes: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Stars that connect the points just as all pairs within the bound would; each point is searched for once."""
    tree = CountTree(points, sizes, percent)
    alive = np.ones(len(points), bool)
    for root in range(len(points)):
        if not alive[root]:
            continue
        alive[root] = False
        front = [root]
        while front and alive.any():
            x = front.pop()
            hit = tree.near(tree.points[x], int(tree.sizes[x]), alive)
            if len(hit):
                alive[hit] = False
                front.extend(hit.tolist())
                yield int(tree.order[root]), tree.order[hit]


def branch_edges(rows: DataFrame, percent: int, *, exact: bool, piece: int = 4096) -> DataFrame:
    """Edges ``a, b`` between the labels of ``rows(bucket, label, size, parity)`` that the bound allows under one branch.

    ``rows`` are a written table.  With ``exact`` the edges connect labels as all pairs of a branch would: a branch of
    more than ``piece`` rows is dealt into pieces, and its rows outside its most frequent label meet every piece.
    Otherwise a crowded branch's rows meet within their piece only, which is for merging labels early.
    """
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    counts = rows.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    crowd = counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("m")).where(F.col("n") > piece)
    parts = F.ceil(F.col("n") / piece).cast("int")
    crowd = staged(crowd.select("bucket", F.col("m.label").alias("main"), parts.alias("parts"), F.ceil((F.col("n") - F.col("m.n")) / piece).cast("int").alias("few")))
    placed = rows.join(crowd, "bucket", "left")
    mine, asks = F.pmod("_row", F.col("parts")).cast("int"), F.pmod(F.xxhash64("_row"), F.col("few")).cast("int")
    if exact:
        upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
        member = F.transform(upto("few"), lambda j: F.xxhash64("bucket", mine, j))
        asker = F.when(F.col("label") != F.col("main"), F.transform(upto("parts"), lambda i: F.xxhash64("bucket", i, asks))).otherwise(F.array().cast("array<long>"))
        spots = F.when(F.col("few") > 0, F.array_distinct(F.concat(member, asker))).otherwise(F.array().cast("array<long>"))
    else:
        spots = F.array(F.xxhash64("bucket", mine, F.lit(0)))
    placed = placed.select(F.explode(F.when(F.col("parts").isNull(), F.array("bucket")).otherwise(spots)).alias("bucket"), "label", "size", *[F.col("parity")[k].alias(f"v{k}") for k in range(_LANES)])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def edges(bucket: np.ndarray, label: np.ndarray, size: np.ndarray, points: np.ndarray) -> Iterator[pa.RecordBatch]:
            cut = np.r_[0, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket)]
            wide = np.diff(cut)
            two = cut[:-1][wide == 2]
            bound = np.minimum(points[two], points[two + 1]).astype(np.int64).sum(1)
            close = two[((100 + percent) * bound >= percent * (size[two] + size[two + 1])) | (points[two] == 65_535).any(1)]
            a, b = [label[close]], [label[close + 1]]
            for i in np.flatnonzero(wide > 2):
                part = slice(cut[i], cut[i + 1])
                own = label[part]
                if (own == own[0]).all():
                    continue
                for root, reached in spanning(points[part], size[part], percent):
                    b.append(own[reached])
                    a.append(np.full(len(reached), own[root]))
            one, other = np.concatenate(a), np.concatenate(b)
            pairs = np.unique(np.stack([np.minimum(one, other), np.maximum(one, other)], 1)[one != other], axis=0)
            if len(pairs):
                yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in pairs.T], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            longs = [np.asarray(c) for c in batch.columns]
            held.append((*longs[:3], np.ascontiguousarray(np.stack(longs[3:], 1)).view(np.uint16)))
            if longs[0][0] == longs[0][-1] and held[0][0][0] == longs[0][0]:
                continue
            cols = tuple(np.concatenate(x) for x in zip(*held))
            last = np.searchsorted(cols[0], cols[0][-1])
            if last:
                yield from edges(*(c[:last] for c in cols))
            held = [tuple(c[last:] for c in cols)]
        if held:
            yield from edges(*(np.concatenate(x) for x in zip(*held)))

    return placed.repartition("bucket").sortWithinPartitions("bucket", "label").mapInArrow(link, "a long, b long")


def jaccard_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90, chunk: int = 512) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    A document's set are its distinct shingles of ``width`` words (A-Z lower-cased; fewer words make one shingle).
    Two documents link when ``100 * intersection >= percent * union``; ``component_id`` is the smallest id that links
    reach, the own included (null only where all ids there are null).  Null and blank texts have no shingles and link
    with nothing.  Documents of equal sets are one point; repeated rows are kept.  Shingles are compared by 64-bit
    hashes, sets told apart by 128 bits.  Other columns do not matter.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.unhex(F.md5(body)).alias("text_key"), F.col(doc_id).cast("long").alias("doc_id"), body.alias("_text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = lambda xs: pa.array([x.view(np.int64) for x in xs], pa.list_(pa.int64()))
        for batch in slices(batches):
            sets = [_shingle_set(t, width) for t in column_bytes(batch, "_text")]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            cols = [pa.array(keys, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), longs([point(s) for s in sets]), longs([branches(s, percent) if len(s) else s for s in sets])]
            yield pa.record_batch([batch.column("text_key"), batch.column("doc_id"), *cols], ["text_key", "doc_id", "set_key", "size", "parity", "prefix"])

    made = staged(rows.mapInArrow(read, "text_key binary, doc_id long, set_key binary, size long, parity array<long>, prefix array<long>"))
    named = made.where("size > 0").groupBy("set_key").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(np.iinfo(np.int64).max)).alias("o"), "text_key", F.col("doc_id").alias("least"))).alias("m"), *[F.max(c).alias(c) for c in ("size", "parity", "prefix")])
    sets = staged(named.select("set_key", "m.text_key", "m.least", "size", "parity", "prefix").withColumn("id", F.monotonically_increasing_id()))
    labels = staged(sets.select("id", F.col("id").alias("label")))

    def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
        roots = components(edges).withColumnRenamed("node", "label")
        return staged(labels.join(roots, "label", "left").select("id", F.coalesce("root", "label").alias("label")))

    # first a few branches of each set, in pieces and then one set of each label, so that crowds have few labels
    some = sets.select("id", "size", "parity", F.slice("prefix", 1, 2).alias("few")).where(F.size("few") > 0)
    early = lambda: some.join(light(labels), "id").select(F.explode("few").alias("bucket"), "label", "size", "parity")
    labels = merged(labels, branch_edges(staged(early()), percent, exact=False))
    one = early().groupBy("bucket", "label").agg(F.min(F.struct("size", "parity")).alias("m")).select("bucket", "label", "m.size", "m.parity")
    labels = merged(labels, branch_edges(staged(one), percent, exact=False))
    # then every branch under which two labels meet
    shared = staged(_shared_prefixes(sets.where(F.size("prefix") > 0).select("id", "size", "parity", "prefix").join(light(labels), "id")))
    labels = merged(labels, branch_edges(staged(shared.select(F.explode("prefix").alias("bucket"), "label", "size", "parity")), percent, exact=True))
    rooted = labels.withColumnRenamed("label", "root")
    crowd = rooted.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root")
    members = sets.select("id", "text_key", "least", "size", "parity").join(light(rooted.join(crowd, "root")), "id")
    group = components(_linked_texts(rows, members, width=width, floor=percent / 100 - 1e-9, chunk=chunk)).withColumnRenamed("node", "id")
    grouped = staged(sets.select("id", "set_key", "least").join(group, "id", "left").select("set_key", "least", F.coalesce("root", "id").alias("group")))
    heads = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    known = staged(grouped.join(heads, "group").select("set_key", "component_id"))
    out = made.select("doc_id", "set_key", F.col("size").alias("n_shingles")).join(known, "set_key", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
