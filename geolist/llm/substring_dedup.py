"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted across the corpus in Spark.

Documents are dealt into blocks by a hash of their id.  A block sends each distinct 64-bit window hash once to the
bucket that owns the hash range.  A bucket answers with one bit per hash: whether another block has it too.  Hashes found twice, here or elsewhere, are only candidates: their
windows are told apart by a 128-bit digest of their words, which goes the same way with the least document id of the
block and is answered by whether a smaller id has the same window.  The block then merges the windows that are to go into maximal removal
intervals.  A window that all documents share costs one entry per block, so it is never a hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, column_ids, hash_bounds, parts_for, planes, unplanes

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word, 42)
        return value


def _windows(words: list[list[bytes]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start position in the block, document index and hash of every window; documents lie end to end."""
    table = _WordHash()
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    code = np.empty(int(sizes.sum()), np.uint64)
    at = 0
    for w in words:
        code[at : at + len(w)] = np.fromiter(map(table.__getitem__, w), np.uint64, len(w))
        at += len(w)
    per = np.maximum(sizes - width + 1, 0)
    doc = np.repeat(np.arange(len(words)), per)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per) + np.repeat(np.cumsum(sizes) - sizes, per)
    h = np.zeros(max(0, len(code) - width + 1), np.uint64)
    for j in range(width):
        h = h * _BASE + code[j : j + len(h)]
    h = h[start]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(32)
    return start, doc, h


class _Block:
    """Documents in id order, their windows, and the distinct window hashes in order.

    ``run`` is each window's place in ``hashes``, ``first`` the first document of each hash.
    """

    def __init__(self, data: pa.Table, width: int):
        ids, texts = column_ids(data, "_id"), column_bytes(data, "_text")
        self.order = np.lexsort((np.fromiter(map(len, texts), np.int64, len(texts)), ids))
        self.ids, self.width = ids[self.order], width
        self.words = [texts[i].split() for i in self.order]
        self.sizes = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.start, self.doc, h = _windows(self.words, width)
        by = np.argsort(h, kind="stable")
        head = np.ones(len(h), bool)
        head[1:] = h[by][1:] != h[by][:-1]
        self.run = np.empty(len(h), np.int64)
        self.run[by] = np.cumsum(head) - 1
        self.hashes, self.first = h[by][head], self.doc[by][head]

    def candidates(self, elsewhere: np.ndarray) -> np.ndarray:
        """Windows whose hash another block has, or another id here."""
        more = elsewhere.copy()
        more[self.run[self.ids[self.doc] != self.ids[self.first[self.run]]]] = True
        return np.flatnonzero(more[self.run])

    def digests(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct 128-bit digests of these windows' words, in order, each window's place in them, and the least id of each."""
        flat = [w for words in self.words for w in words]
        raw = b"".join(xxhash.xxh3_128_digest(b" ".join(flat[i : i + self.width])) for i in self.start[windows].tolist())
        names, place = np.unique(np.frombuffer(raw, "V16").view([("a", ">u8"), ("b", ">u8")]), return_inverse=True)
        least = np.full(len(names), np.iinfo(np.int64).max)
        np.minimum.at(least, place, self.ids[self.doc[windows]])
        return names, place, least


def _flags(replies: pa.Table, cut: np.ndarray, step: int) -> np.ndarray:
    """The answers of a step's buckets, in the order of what was sent."""
    out = np.zeros(cut[-1], bool)
    for b, told, bits in zip(*(replies.column(c).to_pylist() for c in ("bucket", "step", "flags"))):
        if told == step:
            out[cut[b] : cut[b + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=cut[b + 1] - cut[b]).astype(bool)
    return out


_SENT = pa.schema([("bucket", pa.int32()), ("_block", pa.int32()), ("hashes", pa.binary()), ("rest", pa.binary()), ("ids", pa.binary())])
_TOLD = pa.schema([("bucket", pa.int32()), ("_block", pa.int32()), ("step", pa.int32()), ("flags", pa.binary())])


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 13, block_bytes: int | None = None, bucket_bytes: int = 4 << 20) -> DataFrame:
    """Per document: ``doc_id, n_words, n_removed, kept_sha256, kept`` (the kept words, joined by blanks).

    A word goes if a window of ``width`` words over it also starts in a document with a smaller id, judged on
    the input.  Null and blank texts have no words; texts of fewer than ``width`` words have no window.  A null id
    counts as larger than any other; equal ids do not remove each other, nor do null ones.  Rows without an id are
    dealt by their text.  Windows are found by a 64-bit polynomial hash and told apart by a 128-bit digest of
    their words.  ``block_bytes`` of text make a block: by default a 200,000th of all, but 4 MB at least and 32 MB
    at most.  Other columns are not read.
    """
    total = parts_for(docs, text, 1)
    blocks, buckets = -(-total // (block_bytes or min(max(total // 200_000, 4 << 20), 32 << 20))), -(-total // bucket_bytes)
    dealt = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"))
    dealt = dealt.withColumn("_block", F.pmod(F.xxhash64("_id", F.when(F.col("_id").isNull(), F.xxhash64("_text"))), F.lit(blocks)).cast("int"))

    def parcels(block: int, hashes: np.ndarray, rest: np.ndarray, ids: np.ndarray) -> pa.Table:
        cut, rows = hash_bounds(hashes, buckets), []
        for b in np.flatnonzero(cut[1:] > cut[:-1]):
            part = slice(cut[b], cut[b + 1])
            rows.append((int(b), block, planes(np.diff(hashes[part], prepend=np.uint64(0))), rest[part].tobytes(), planes(ids[part]) if len(ids) else b""))
        cols = list(zip(*rows)) or [[]] * 5
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, _SENT)], schema=_SENT)

    def send(key: tuple, data: pa.Table) -> pa.Table:
        block = _Block(data, width)
        return parcels(key[0].as_py(), block.hashes, np.empty(0, np.uint64), np.empty(0, np.int64))

    def send_words(key: tuple, data: pa.Table, replies: pa.Table) -> pa.Table:
        if not data.num_rows:
            return _SENT.empty_table()
        block = _Block(data, width)
        names, _, least = block.digests(block.candidates(_flags(replies, hash_bounds(block.hashes, buckets), 1)))
        return parcels(key[0].as_py(), names["a"].astype(np.uint64), names["b"].astype(np.uint64), least)

    def answer(step: int):
        def reply(data: pa.Table) -> pa.Table:
            hashes = [np.cumsum(unplanes(x, np.uint64), dtype=np.uint64) for x in data.column("hashes").to_pylist()]
            every = np.concatenate(hashes)
            if step == 1:
                by = np.argsort(every, kind="stable")
                new = every[by][1:] != every[by][:-1]
            else:
                ids = np.concatenate([unplanes(x, np.int64) for x in data.column("ids").to_pylist()])
                rest = np.concatenate([np.frombuffer(x, np.uint64) for x in data.column("rest").to_pylist()])
                by = np.lexsort((rest, every))
                new = (every[by][1:] != every[by][:-1]) | (rest[by][1:] != rest[by][:-1])
            head = np.flatnonzero(np.r_[True, new])
            size = np.diff(np.r_[head, len(every)])
            told = np.empty(len(every), bool)
            if step == 1:
                told[by] = np.repeat(size > 1, size)
            else:
                told[by] = ids[by] > np.repeat(np.minimum.reduceat(ids[by], head), size)
            flags = [np.packbits(x).tobytes() for x in np.split(told, np.cumsum([len(h) for h in hashes])[:-1])]
            return pa.table([data.column("bucket"), data.column("_block"), pa.array(np.full(len(flags), step, np.int32)), pa.array(flags, pa.binary())], schema=_TOLD)

        return reply

    def cut_out(key: tuple, data: pa.Table, replies: pa.Table) -> pa.Table:
        block = _Block(data, width)
        windows = block.candidates(_flags(replies, hash_bounds(block.hashes, buckets), 1))
        names, place, least = block.digests(windows)
        late = _flags(replies, hash_bounds(names["a"].astype(np.uint64), buckets), 2)
        gone = block.start[windows[late[place] | (block.ids[block.doc[windows]] > least[place])]]
        size = int(block.sizes.sum())
        covered = np.cumsum(np.bincount(gone, minlength=size + 1) - np.bincount(gone + width, minlength=size + 1))[:-1] > 0
        removed, sums, kept = [], [], []
        at = 0
        for w in block.words:
            drop = covered[at : at + len(w)]
            at += len(w)
            n = int(drop.sum())
            left = b" ".join(w if not n else [x for x, d in zip(w, drop.tolist()) if not d])
            removed.append(n)
            sums.append(hashlib.sha256(left).hexdigest())
            kept.append(left)
        back = data.column("_id").take(pa.array(block.order))
        return pa.table([back, pa.array(block.sizes), pa.array(removed, pa.int64()), pa.array(sums), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    sent, told = "bucket int, _block int, hashes binary, rest binary, ids binary", "bucket int, _block int, step int, flags binary"
    by_block = dealt.groupBy("_block")
    first = by_block.applyInArrow(send, sent).groupBy("bucket").applyInArrow(answer(1), told)
    first = first.where(F.translate(F.hex("flags"), "0", "") != "")  # used twice; one job, so texts are dealt once
    second = by_block.cogroup(first.groupBy("_block")).applyInArrow(send_words, sent).groupBy("bucket").applyInArrow(answer(2), told)
    return by_block.cogroup(first.union(second).groupBy("_block")).applyInArrow(cut_out, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


#: The same for DuckDB over ``documents``, without the kept texts.
REPEATS_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
x AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
f AS (SELECT g, min(doc_id) AS d FROM x GROUP BY g HAVING count(*) > 1),
e AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM x JOIN f USING (g) WHERE d < doc_id),
a AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
k AS (SELECT doc_id, count(e.p) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE e.p IS NULL) AS kept FROM a LEFT JOIN e USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)"""
