"""SimHash near-dedup by covering locality-sensitive hashing.

For radius r every bit position gets a non-zero vector of r + 1 bits.  Each of the 2**(r + 1) - 1 non-zero
vectors v makes a mask of the positions whose vector has odd inner product with v.  The up to r positions
in which two fingerprints differ span at most r dimensions, so some v is orthogonal to all of them: under that
mask the two agree.  Thus every pair within the radius meets in some table, by construction and not by chance.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, components, free_since, hash_bounds, light, mark_staged, planes, shared_dir, slices, staged, unplanes

#: Bits of the parities that candidate pairs are bounded by.
_PARITY = 512
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(float)


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """Signed 64-bit masks such that any two values within ``radius`` bits agree under one of them."""
    size = 1 << (radius + 1)
    vector = [i % (size - 1) + 1 for i in range(bits)]
    masks = [sum(1 << i for i, m in enumerate(vector) if (m & v).bit_count() & 1) for v in range(1, size)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _majority(hashes: np.ndarray, weights: np.ndarray | None = None) -> int:
    """The bits that are set in over half the (weighted) hashes."""
    if not len(hashes):
        return 0
    rows = hashes.view(np.uint8).reshape(-1, 8)
    total = float(len(hashes)) if weights is None else float(weights.sum())
    out = 0
    for k in range(8):
        ones = np.bincount(rows[:, k], weights, 256) @ _BITS
        out |= int(np.packbits(2 * ones > total, bitorder="little")[0]) << (8 * k)
    return out


def shingle_print(words: list[bytes], width: int, seed: int = 42) -> int:
    """SimHash of the ``width``-word shingles, repeats included; fewer words make one shingle, none gives 0."""
    if not words:
        return 0
    parts = [b" ".join(words)] if len(words) < width else words if width == 1 else map(b" ".join, zip(*(words[i:] for i in range(width))))
    return _majority(np.fromiter((xxhash.xxh64_intdigest(p, seed) for p in parts), np.uint64))


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``doc_id, fp`` (signed 64-bit) of every whole text, A-Z lower-cased; null and blank texts give 0."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [shingle_print(t.lower().split(), width) for t in column_bytes(batch, "_text")]
            yield pa.record_batch([batch.column("doc_id"), _signed(out)], ["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text")).mapInArrow(prints, "doc_id long, fp long")


def _spanning(cols: tuple[np.ndarray, ...], near: Callable) -> Iterator[tuple[int, np.ndarray]]:
    """Spanning stars of the link graph inside one bucket, without listing its pairs.

    Each member is visited once and compared with those not yet reached, which it removes: a bucket of mutual
    near copies costs one pass.
    """
    left = np.arange(len(cols[0]))
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            x = front.pop()
            close = near([c[x] for c in cols], [c[left] for c in cols])
            if close.any():
                reached = left[close]
                yield root, reached
                front.extend(reached.tolist())
                left = left[~close]


def _bucket_edges(rows: DataFrame, near: Callable) -> DataFrame:
    """Edges ``a, b`` that connect the labels inside each bucket just as all pairs that are ``near`` would.

    ``rows`` are ``bucket, label`` and long columns, which ``near`` gets as unsigned values of one member and of
    many.  Each bucket is reduced to spanning edges in one pass over sorted rows; edges inside a label are not
    sent, and each pair of labels goes once a piece.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def edges(bucket: np.ndarray, label: np.ndarray, *cols: np.ndarray) -> Iterator[pa.RecordBatch]:
            cut = np.r_[0, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket)]
            size = np.diff(cut)
            two = cut[:-1][size == 2]
            close = two[near([c[two] for c in cols], [c[two + 1] for c in cols])]
            a, b = [label[close]], [label[close + 1]]
            for i in np.flatnonzero(size > 2):
                part = slice(cut[i], cut[i + 1])
                if (label[part] == label[cut[i]]).all():
                    continue
                for root, reached in _spanning(tuple(c[part] for c in cols), near):
                    b.append(label[part][reached])
                    a.append(np.full(len(reached), label[part][root]))
            one, two = np.concatenate(a), np.concatenate(b)
            pairs = np.unique(np.stack([np.minimum(one, two), np.maximum(one, two)], 1)[one != two], axis=0)
            if len(pairs):
                yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in pairs.T], ["a", "b"])

        for batch in batches:
            cols = tuple(np.asarray(c).view(np.int64 if k < 2 else np.uint64) for k, c in enumerate(batch.columns))  # bits are counted on unsigned values
            if not len(cols[0]):
                continue
            held.append(cols)
            if cols[0][0] == cols[0][-1] and held[0][0][0] == cols[0][0]:
                continue  # one bucket so far: pieces are joined once, when it ends
            cols = tuple(np.concatenate(x) for x in zip(*held))
            last = np.searchsorted(cols[0], cols[0][-1])  # the last bucket may go on in the next batch
            yield from edges(*(c[:last] for c in cols))
            held = [tuple(c[last:] for c in cols)]
        if held:
            yield from edges(*(np.concatenate(x) for x in zip(*held)))

    return rows.repartition("bucket").sortWithinPartitions("bucket", "label").mapInArrow(link, "a long, b long")


def link_edges(points: DataFrame, radius: int) -> DataFrame:
    """Edges ``a, b`` that connect the labels of ``points(id, fp)`` just as all links within ``radius`` would.

    A point's label is its id unless there is a column ``label``: edges then join labels and none is sent inside
    one.  With a column ``family``, fingerprints are compared within their family only.  Points go to one bucket
    per covering mask.  Buckets hold distinct points, so copies of one text never crowd one.
    """
    masks = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(covering_masks(radius))])
    family = F.col("family") if "family" in points.columns else F.lit(0)
    label = F.col("label") if "label" in points.columns else F.col("id")
    rows = points.select("fp", label.alias("label"), family.alias("f"), F.explode(masks).alias("m")).select(F.xxhash64("f", "m.t", "m.key").alias("bucket"), "label", "fp")
    return _bucket_edges(rows, lambda x, y: np.bitwise_count(y[0] ^ x[0]) <= radius)


def _one_each(edges: DataFrame) -> DataFrame:
    """Of edges ``a < b`` the one with the least ``a`` for each ``b``: no more edges than nodes, combined before the shuffle."""
    return edges.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")


def simhash_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` for every row of ``docs``.

    Fingerprints link at ``radius`` or fewer differing bits; the component id is the smallest document id that
    links reach (null only if all ids there are null).  Texts without words have fingerprint zero and link like
    any other.  Repeated rows are kept.  Equal fingerprints are one point, so copies cost nothing.
    """
    prints = staged(fingerprints(docs, doc_id=doc_id, text=text, width=width))
    points = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    edges = link_edges(points.select(F.col("fp").alias("id"), "fp"), radius)
    label = components(edges)
    rooted = points.join(label.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    rooted = staged(rooted)
    heads = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(rooted.join(heads, "root").select("fp", "component_id"))
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def word_prints(count: Counter, families: int) -> list[int]:
    """Independent SimHashes of words, each weighted by the root of its count."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in count), np.uint64, len(count))
    weights = np.sqrt(np.fromiter(count.values(), float, len(count)))
    out = []
    for k in range(families):
        mixed = (hashes ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        out.append(_majority(mixed ^ (mixed >> np.uint64(32)), weights))
    return out


def _shingle_set(text: bytes, width: int) -> np.ndarray:
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    parts = [b" ".join(words)] if len(words) < width else map(b" ".join, zip(*(words[i:] for i in range(width))))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(p, 1) for p in parts), np.uint64))


def _parity(shingles: np.ndarray, bits: int) -> np.ndarray:
    """For each of ``bits`` hash classes, whether an odd number of the shingles is in it, as 64-bit words.

    A shingle that only one of two texts has turns one bit, so the parities of two sets differ in no more bits
    than the sets differ in shingles.
    """
    odd = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _sketch_bits(size: int) -> int:
    """Bits of a parity sketch that tells sets of ``size`` apart: a power of two, half the size at least.

    Unrelated sets differ in nearly half the bits, similar ones (0.8) in at most 0.22 times the size.
    """
    return max(2048, 1 << max(0, (size - 1) // 2).bit_length())


def _folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Parity sketches of fewer bits: classes modulo the smaller number are the sums of those modulo the larger."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, words), axis=1)


def _may_reach(floor: float, n: np.ndarray, m: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Whether sets of ``n`` and ``m`` shingles whose parities differ in ``differ`` bits can be ``floor`` similar (never wrongly no)."""
    n, m = n.astype(np.float64), m.astype(np.float64)
    return (np.minimum(n, m) >= floor * np.maximum(n, m) - 1e-6) & (differ <= (1 - floor) / (1 + floor) * (n + m) + 1e-6)


def _spare(size: np.ndarray | int, floor: float) -> np.ndarray:
    """How many shingles a prefix has beyond those that make two similar sets share one: a quarter of the least overlap."""
    return np.ceil(floor * np.asarray(size) - 1e-6).astype(np.int64) // 4


def _prefix(shingles: np.ndarray, common: np.ndarray, often: np.ndarray, floor: float) -> np.ndarray:
    """The rarest shingles of a sorted set, so many that two sets of similarity ``floor`` or more share more than the ``_spare`` of either.

    Any fixed order of all shingles does for this; shingles outside the sorted ``common`` count as the rarest.  Let t be
    the least overlap that a set allows, ``floor`` times its size, and s its spare.  The sets share no less than the larger
    t, and of this no more lies outside the prefix that ends first than its set has there, t - 1 - s.  So the prefixes
    share s + 1 of that set and the difference of the two t besides, which the difference of the two s does not exceed.
    """
    keep = len(shingles) - int(np.ceil(floor * len(shingles) - 1e-6)) + 1 + int(_spare(len(shingles), floor))
    if not len(common):
        return shingles[:keep]
    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
    return shingles[np.argsort(np.where(common[at] == shingles, often[at], 0), kind="stable")[:keep]]


def _common_shingles(rows: DataFrame, width: int, texts: int = 10_000, most: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that occur in three or more of a sample of about ``texts`` rows, and in how many (sorted, at most ``most``).

    They only set the order of shingles; what is found does not depend on them.
    """
    every = max(1, rows.count() // texts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in column_bytes(batch, "_text"):
                yield pa.record_batch([pa.array(_shingle_set(t, width).view(np.int64))], ["h"])

    sample = rows.where(F.pmod(F.xxhash64("text_key"), F.lit(every)) == 0).dropDuplicates(["text_key"]).select("_text")
    found = sample.mapInArrow(cut, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 2").orderBy(F.desc("n"), "h").limit(most).toArrow()
    h, n = np.asarray(found.column("h")).view(np.uint64), np.asarray(found.column("n"))
    order = np.argsort(h)
    return h[order], n[order]


def _packed(prefix: np.ndarray) -> bytes:
    """The high 40 bits of the hashes, sorted, as differences: half the bytes once compressed.

    Shingles that agree in them count as one from here on, so texts may meet in vain but none is missed.
    """
    return planes(np.diff(np.sort(prefix & ~np.uint64(0xFFFFFF)), prepend=np.uint64(0)))


def _rarest_shared(count: np.ndarray, flat: np.ndarray, owner: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """Which shingles of each owner's prefix stay: those with a ``count``, without the ``spare`` most frequent ones.

    Similar sets share more than the spare of either.  In an order that is the same for all, the rarest of what they
    share has more than the spare above it in both, so it stays in both.
    """
    order = np.lexsort((flat, count, owner))
    left = np.cumsum(np.bincount(owner, minlength=len(spare)))[owner[order]] - np.arange(len(order))
    keep = np.zeros(len(flat), bool)
    keep[order] = (left > spare[owner[order]]) & (count[order] > 0)
    return keep


def _shared_prefixes(texts: DataFrame, floor: float | None = None, block_hashes: int = 500_000) -> DataFrame:
    """``texts(id, label, size, parity, prefix)`` with those prefix shingles only by which texts of other labels are to be met.

    Prefixes are arrays or ``_packed``.  The texts of a label are in one block, which stands for the label, unless they
    would crowd it.  Blocks send their distinct hashes, sorted and packed, each with how many texts have it and with its
    label if that is spread, to the owner of each range of hashes, which answers with the number of texts in all, or
    none for a shingle that is met under one label.  With a ``floor``, each text leaves out the spare part of its prefix by these exact numbers.
    """
    packed = dict(texts.dtypes)["prefix"] == "binary"
    by_label = staged(texts.groupBy("label").agg(F.sum(F.octet_length("prefix") / 8 if packed else F.size("prefix")).alias("_n")))
    parts = max(1, -(-int(by_label.agg(F.sum("_n")).first()[0] or 0) // block_hashes))
    spread = light(by_label.where(F.col("_n") > block_hashes // 8).select("label", F.lit(True).alias("spread")))
    texts = texts.join(spread, "label", "left").withColumn("spread", F.coalesce("spread", F.lit(False)))
    block = F.pmod(F.xxhash64(F.when(F.col("spread"), F.col("id")).otherwise(F.col("label"))), F.lit(parts)).cast("int")
    dealt = texts.select("label", "spread", "size", "parity", "prefix", block.alias("_block")).groupBy("_block")

    def hashes_of(data: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if packed:
            lists = [np.cumsum(unplanes(x, np.uint64), dtype=np.uint64) for x in data.column("prefix").to_pylist()]
            length, flat = np.array([len(x) for x in lists], np.int64), np.concatenate([*lists, np.empty(0, np.uint64)])
        else:
            lists = data.column("prefix").combine_chunks()
            length, flat = np.asarray(pc.list_value_length(lists)), np.asarray(lists.flatten()).view(np.uint64)
        every, place = np.unique(flat, return_inverse=True)
        return length, flat, place, every

    def send(key: tuple, data: pa.Table) -> pa.Table:
        length, _, place, every = hashes_of(data)
        label = np.repeat(np.asarray(data.column("label")), length)
        low, high = np.full(len(every), np.iinfo(np.int64).max), np.full(len(every), np.iinfo(np.int64).min)
        np.minimum.at(low, place, label)
        np.maximum.at(high, place, label)
        alone = ~np.repeat(np.asarray(data.column("spread")), length)
        mixed, low[place[alone]] = low < high, key[0].as_py()
        cut, times, rows = hash_bounds(every, parts), np.bincount(place, minlength=len(every)), []
        for b in np.flatnonzero(cut[1:] > cut[:-1]):
            part = slice(cut[b], cut[b + 1])
            rows.append((int(b), key[0].as_py(), planes(np.diff(every[part], prepend=np.uint64(0))), planes(low[part]), planes(times[part]), np.packbits(mixed[part]).tobytes()))
        cols = list(zip(*rows)) or [[]] * 6
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), *[pa.binary()] * 4))], ["bucket", "_block", "hashes", "labels", "times", "mixed"])

    def answer(data: pa.Table) -> pa.Table:
        pieces = [np.cumsum(unplanes(x, np.uint64), dtype=np.uint64) for x in data.column("hashes").to_pylist()]
        label, times = (np.concatenate([unplanes(x, np.int64) for x in data.column(c).to_pylist()]) for c in ("labels", "times"))
        mixed = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(h)) for x, h in zip(data.column("mixed").to_pylist(), pieces)]).astype(bool)
        every = np.concatenate(pieces)
        by = np.argsort(every, kind="stable")
        head = np.flatnonzero(np.r_[True, every[by][1:] != every[by][:-1]])
        size = np.diff(np.r_[head, len(every)])
        shared = (np.minimum.reduceat(label[by], head) < np.maximum.reduceat(label[by], head)) | np.logical_or.reduceat(mixed[by], head)
        count = np.empty(len(every), np.int64)
        count[by] = np.repeat(np.where(shared, np.add.reduceat(times[by], head), 0), size)
        counts = [planes(x) for x in np.split(count, np.cumsum([len(h) for h in pieces])[:-1])]
        return pa.table([data.column("bucket"), data.column("_block"), pa.array(counts, pa.binary())], ["bucket", "_block", "counts"])

    def take(data: pa.Table, replies: pa.Table) -> pa.Table:
        length, flat, place, every = hashes_of(data)
        cut = hash_bounds(every, parts)
        count = np.zeros(len(every), np.int64)
        for b, packed in zip(replies.column("bucket").to_pylist(), replies.column("counts").to_pylist()):
            count[cut[b] : cut[b + 1]] = unplanes(packed, np.int64)
        owner = np.repeat(np.arange(len(length)), length)
        keep = count[place] > 0 if floor is None else _rarest_shared(count[place], flat, owner, _spare(np.asarray(data.column("size")), floor))
        ends = np.cumsum(np.bincount(owner[keep], minlength=len(length)))
        kept = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(flat[keep].view(np.int64)))
        return pa.table([data.column("label"), data.column("size"), data.column("parity"), kept], ["label", "size", "parity", "prefix"]).filter(pa.array(np.diff(np.r_[0, ends]) > 0))

    told = dealt.applyInArrow(send, "bucket int, _block int, hashes binary, labels binary, times binary, mixed binary").groupBy("bucket").applyInArrow(answer, "bucket int, _block int, counts binary")
    return dealt.cogroup(told.groupBy("_block")).applyInArrow(take, "label long, size long, parity array<long>, prefix array<long>")


def _alike(sets: list[np.ndarray], size: np.ndarray, parity: np.ndarray, x: int, others: np.ndarray, floor: float) -> Iterator[int]:
    """Those of ``others`` whose Jaccard similarity with ``x`` is ``floor`` or more."""
    for y in others[_may_reach(floor, size[others], size[x], np.bitwise_count(parity[others] ^ parity[x]).sum(1))]:
        common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        if common >= floor * (size[x] + size[y] - common):
            yield int(y)


def _similar_stars(sets: list[np.ndarray], floor: float) -> Iterator[tuple[int, np.ndarray]]:
    """Spanning stars of the texts with Jaccard similarity of ``floor`` or more, each visited once."""
    size = np.array([len(s) for s in sets])
    parity = np.stack([_parity(s, _sketch_bits(int(size.max()))) for s in sets]) if len(sets) else size
    left = np.arange(len(sets))
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            x = front.pop()
            hit = list(_alike(sets, size, parity, x, left, floor))
            if hit:
                reached = np.array(hit)
                yield root, reached
                front.extend(hit)
                left = left[~np.isin(left, reached)]


def _cross_links(sets: list[np.ndarray], label: np.ndarray, few: np.ndarray, floor: float) -> Iterator[tuple[int, int]]:
    """Pairs of similar texts, one of them in ``few``, that connect labels as all such pairs would."""
    size = np.array([len(s) for s in sets])
    parity = np.stack([_parity(s, _sketch_bits(int(size.max()))) for s in sets]) if len(sets) else size
    label = label.copy()
    for x in few:
        while len(others := np.flatnonzero(label != label[x])):
            y = next(_alike(sets, size, parity, x, others, floor), None)
            if y is None:
                break
            yield int(x), y
            label[label == label[y]] = label[x]


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each ``id`` a task, so that repeated rows of one text do not all travel."""
    seen: set[int] = set()
    for batch in batches:
        fresh = []
        for i in batch.column("id").to_pylist():
            fresh.append(i not in seen)
            seen.add(i)
        yield batch.filter(pa.array(fresh, pa.bool_()))


def _linked_texts(rows: DataFrame, members: DataFrame, *, width: int, floor: float, chunk: int) -> DataFrame:
    """Edges ``a, b`` of exact similarity that connect the texts of each candidate group as all its links would.

    ``rows`` are ``text_key, doc_id, _text``; ``members`` are ``id, root, text_key, least, size, parity`` with one
    ``root`` a group.  A group that fits a piece is compared whole.  A larger one is dealt into pieces that are
    each compared within, and with the group's head: the text nearest to the majority of its parity bits, which
    the copies of one original share.  Texts that so far hang together with most of the group need not meet each
    other again.  Of every other cluster one text meets all pieces, which brings the parts of a cluster together, and
    then each text that is still outside does: by sketches first, and by text where these allow a link.  No task
    holds more than two pieces.
    """
    sizes = members.groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("s")).select("root", F.ceil(F.greatest(F.col("n") / chunk, F.col("s") / 1_000_000)).cast("int").alias("parts"))
    members = staged(members.join(sizes, "root").select("id", "root", "parts", F.pmod("id", F.col("parts")).cast("int").alias("i"), "parity", F.col("text_key").alias("_k"), F.col("least").alias("_l")))
    asked = light(members.drop("parity"))
    held = rows.join(asked, (F.col("text_key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_l"))).select("root", "i", "parts", "id", "_text")
    held = staged(held.mapInArrow(_first_of_each, held.schema))
    big = members.where("parts > 1")

    def majority(data: pa.Table) -> pa.Table:
        bits = np.unpackbits(np.array(data.column("parity").to_pylist(), np.int64).view(np.uint8), axis=1, bitorder="little")
        most = np.packbits(2 * bits.sum(0) > len(bits), bitorder="little").view(np.int64)
        return pa.table([data.column("root")[:1], pa.array([most], pa.list_(pa.int64())), data.column("parts")[:1]], ["root", "most", "parts"])

    every = lambda col: F.explode(F.sequence(F.lit(0), F.col(col) - 1))
    centre = big.where("i = 0").groupBy("root").applyInArrow(majority, "root long, most array<long>, parts int").select("root", "most", every("parts").alias("i"))
    apart = sum(F.bit_count(F.col("parity")[k].bitwiseXOR(F.col("most")[k])) for k in range(_PARITY // 64))
    heads = big.join(centre, ["root", "i"]).groupBy("root").agg(F.min(F.struct(apart.alias("far"), "id")).alias("h")).select(F.col("h.id").alias("id"))
    heads = staged(held.join(heads, "id", "left_semi").select("root", "parts", "id", "_text")).select("root", "id", "_text", every("parts").alias("i"))

    def sets_of(*tables: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
        found = {}
        for data in tables:
            for i, body in zip(data.column("id").to_pylist(), column_bytes(data, "_text")):
                found.setdefault(i, body)
        ids = sorted(found)
        return np.array(ids, np.int64), [_shingle_set(found[i], width) for i in ids]

    def within(mine: pa.Table, head: pa.Table) -> pa.Table:
        ids, sets = sets_of(mine, head)
        pairs = [(ids[root], ids[y]) for root, reached in _similar_stars(sets, floor) for y in reached] if len(ids) else []
        return pa.table([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], schema=_LINKS)

    links = staged(held.select("root", "i", "id", "_text").groupBy("root", "i").cogroup(heads.groupBy("root", "i")).applyInArrow(within, "a long, b long"))
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [_shingle_set(t, width) for t in column_bytes(batch, "_text")]
            made = [pa.array([len(x) for x in sets], pa.int64()), pa.array([_parity(x, _sketch_bits(len(x))).tobytes() for x in sets], pa.binary())]
            yield pa.record_batch([*(batch.column(c) for c in ("root", "i", "parts", "id")), *made], ["root", "i", "parts", "id", "size", "sketch"])

    def meet(data: pa.Table) -> pa.Table:
        few = np.asarray(data.column("few"))
        size, label = np.asarray(data.column("size")), np.asarray(data.column("label"))
        sketches = [np.frombuffer(x, np.uint64) for x in data.column("sketch").to_pylist()]
        wide = np.array([len(x) for x in sketches])
        mine, may = np.flatnonzero(~few), np.zeros(len(few), bool)
        by_width = {w: (at := mine[wide[mine] == w], np.stack([sketches[k] for k in at])) for w in np.unique(wide[mine]).tolist()}
        shorter: dict[tuple[int, int], np.ndarray] = {}
        for x in np.flatnonzero(few):
            for w, (at, bits) in by_width.items():
                words = min(w, int(wide[x]))
                if (w, words) not in shorter:
                    shorter[w, words] = _folded(bits, words)
                differ = np.bitwise_count(shorter[w, words] ^ _folded(sketches[x][None], words)).sum(1)
                near = at[(label[at] != label[x]) & _may_reach(floor, size[at], size[x], differ)]
                may[near] = True
                may[x] |= len(near) > 0
        return data.select(["root", "i", "j", "few", "id", "label"]).filter(pa.array(may))

    def across(data: pa.Table) -> pa.Table:
        ids, sets = sets_of(data)
        label = np.empty(len(ids), np.int64)
        label[np.searchsorted(ids, np.asarray(data.column("id")))] = np.asarray(data.column("label"))
        some = np.searchsorted(ids, np.unique(np.asarray(data.column("id"))[np.asarray(data.column("few"))]))
        pairs = [(ids[x], ids[y]) for x, y in _cross_links(sets, label, some, floor)]
        return pa.table([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], schema=_LINKS)

    # who may meet at all is told by short sketches; only the texts of those move again
    short = staged(held.where("parts > 1").mapInArrow(sketch, "root long, i int, parts int, id long, size long, sketch binary"))
    own = ["id", "label", "size", "sketch"]
    # first one text of each cluster outside the main one meets the group, then every text that is still outside
    for only_heads in (True, False):
        mark = mark_staged()
        group = components(links).withColumnRenamed("node", "id").withColumnRenamed("root", "label")
        labelled = staged(short.join(group, "id", "left").withColumn("label", F.coalesce("label", "id")))
        counts = labelled.groupBy("root", "label").agg(F.count("*").alias("n"), F.min("id").alias("head"))
        main = counts.groupBy("root").agg(F.max(F.struct("n", "label")).alias("m")).select("root", F.col("m.label").alias("main"))
        outside = counts.join(main, "root").where("label <> main")
        some = outside.select(F.col("head").alias("id")) if only_heads else labelled.select("id", "label").join(outside.select("label"), "label").select("id")
        few = staged(labelled.join(some, "id"))
        rest = staged(few.groupBy("root").agg(F.ceil(F.count("*") / chunk).cast("int").alias("rest")))
        if rest.isEmpty():
            break
        asked = few.join(rest, "root").withColumn("j", F.pmod(F.xxhash64("id"), F.col("rest")).cast("int"))
        asked = asked.select("root", "j", every("parts").alias("i"), F.lit(True).alias("few"), *own)
        every_one = labelled.join(rest, "root").select("root", "i", every("rest").alias("j"), F.lit(False).alias("few"), *own)
        may = staged(asked.unionByName(every_one).groupBy("root", "i", "j").applyInArrow(meet, "root long, i int, j int, few boolean, id long, label long"))
        met = may.join(held.select("id", "_text"), "id").groupBy("root", "i", "j").applyInArrow(across, "a long, b long")
        path = shared_dir(rows.sparkSession)
        links = staged(links.union(met), path)
        free_since(rows.sparkSession, mark, keep=path)
    return links


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 5, min_similarity: float = 0.8, radius: int = 3, families: int = 4, chunk: int = 512) -> DataFrame:
    """Distinct texts with their group: ``text_key`` (MD5), ``least`` (smallest doc id), ``keep_key, keep_id``.

    Two texts are near duplicates if the sets of their ``width``-word shingles (A-Z lower-cased) have Jaccard
    similarity of ``min_similarity`` or more; groups are connected by such links.  Candidates come from covering
    tables over ``families`` independent SimHashes of the words (one within ``radius`` is enough) and, since these
    miss texts that differ in one piece, from rarest-first prefix shingles that two texts share: that part misses no
    link.  Prefixes are longer than a link needs; once it is known in how many texts each shingle is, those met under
    one label go, and of the others the most frequent, as many as the prefix is longer, so that texts that share
    a passage and no more do not meet.  Its pairs are told apart by length and by 512 parity bits, bounds that every true link meets.  The first family's tables are read first, with one edge a
    fingerprint, and label most of each crowded group; the other tables, and after them the prefixes, then only send
    edges between labels, so that edges grow with the texts and not with the tables.  Every candidate group is then verified by exact similarity (``_linked_texts``).  Null
    and blank texts have no shingles: each distinct one is a group of its own (null counts as empty).
    """
    spark, mark = docs.sparkSession, mark_staged()
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.unhex(F.md5(body)).alias("text_key"), F.col(doc_id).cast("long").alias("doc_id"), body.alias("_text"))
    common, often = _common_shingles(rows, width)

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = lambda xs: pa.array([x.view(np.int64) for x in xs], pa.list_(pa.int64()))
        for batch in slices(batches):
            own, size, parity, prefix = [], [], [], []
            for t in column_bytes(batch, "_text"):
                own.append(np.array(word_prints(Counter(t.lower().split()), families), np.uint64))
                shingles = _shingle_set(t, width)
                size.append(len(shingles))
                parity.append(_parity(shingles, _PARITY))
                prefix.append(_packed(_prefix(shingles, common, often, min_similarity)) if len(shingles) else b"")
            yield pa.record_batch([batch.column("text_key"), batch.column("doc_id"), longs(own), pa.array(size, pa.int64()), longs(parity), pa.array(prefix, pa.binary())], ["text_key", "doc_id", "fps", "size", "parity", "prefix"])

    made = rows.mapInArrow(prints, "text_key binary, doc_id long, fps array<long>, size long, parity array<long>, prefix binary")
    texts = staged(made.groupBy("text_key").agg(F.min("doc_id").alias("least"), *[F.max(c).alias(c) for c in ("fps", "size", "parity", "prefix")]).withColumn("id", F.xxhash64("text_key")))
    worded = texts.where("size > 0").withColumn("fp", F.col("fps")[0])
    first = staged(worded.groupBy("fp").agg(F.min("id").alias("id")))
    label = components(_one_each(link_edges(first, radius))).withColumnRenamed("node", "id")
    named = first.join(label, "id", "left").select("fp", F.coalesce("root", "id").alias("label"))
    labels = staged(worded.select("id", "fp").join(named, "fp").select("id", "label"))
    # texts with one fingerprint are one point of a family; the labels of the others hang on its label
    points = texts.select("id", "fps").join(labels, "id").select("label", F.posexplode("fps").alias("family", "fp"))
    heads = staged(points.groupBy("family", "fp").agg(F.min("label").alias("label"), F.max("label").alias("top")))
    hung = points.join(heads.where("label < top").withColumnRenamed("label", "a"), ["family", "fp"]).where("label > a").select("a", F.col("label").alias("b"))

    def merged(edges: DataFrame) -> DataFrame:
        return staged(labels.join(components(edges).withColumnRenamed("node", "label"), "label", "left").select("id", F.coalesce("root", "label").alias("label")))

    labels = merged(link_edges(heads, radius).union(hung))
    shared = staged(_shared_prefixes(worded.select("id", "size", "parity", "prefix").join(labels, "id"), min_similarity))
    shared = shared.select(F.explode("prefix").alias("bucket"), "label", "size", *[F.col("parity")[k].alias(f"p{k}") for k in range(_PARITY // 64)])
    labels = merged(_bucket_edges(shared, lambda x, y: _may_reach(min_similarity, x[0], y[0], sum(np.bitwise_count(u ^ v).astype(np.int64) for u, v in zip(x[1:], y[1:])))))
    rooted = labels.withColumnRenamed("label", "root")
    crowd = rooted.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root")
    members = texts.select("id", "text_key", "least", "size", "parity").join(rooted.join(crowd, "root"), "id")
    group = components(_linked_texts(rows, members, width=width, floor=min_similarity, chunk=chunk)).withColumnRenamed("node", "id")
    path = shared_dir(spark)
    grouped = staged(texts.select("id", "text_key", "least").join(group, "id", "left").select("text_key", "least", F.coalesce("root", "id").alias("group")), path)
    free_since(spark, mark, keep=path)
    heads = grouped.groupBy("group").agg(F.min(F.struct(F.coalesce("least", F.lit(np.iinfo(np.int64).max)).alias("o"), F.col("text_key").alias("keep_key"), F.col("least").alias("keep_id"))).alias("h"))
    return grouped.join(heads, "group").select("text_key", "least", "h.keep_key", "h.keep_id")


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", broadcast_rows: int = 1_000_000, **options) -> DataFrame:
    """One document of each group of copies and near copies, the one with the smallest id, with all its columns.

    The keys of what stays (24 bytes each) are sent to the texts while there are at most ``broadcast_rows`` of them.
    Rows equal in id and text count once, whichever of them stays.  Null texts count as empty; a group whose ids
    are all null keeps one row.  Names of other columns do not matter.
    """
    groups = near_duplicates(docs, doc_id=doc_id, text=text, **options)
    keep = staged(groups.where(F.col("text_key") == F.col("keep_key")).select("text_key", "keep_id"))
    n = keep.count()
    keep = F.broadcast(keep) if n <= broadcast_rows else keep
    whole = docs.select(F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("text_key"), F.col(doc_id).cast("long").alias("keep_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = whole["text_key"].eqNullSafe(keep["text_key"]) & whole["keep_id"].eqNullSafe(keep["keep_id"])
    kept = whole.join(keep, same, "left_semi")
    if kept.count() > n:  # some row is repeated whole: only then are rows brought together
        kept = kept.dropDuplicates(["text_key"])
    return kept.select("row.*")
