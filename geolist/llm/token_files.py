"""Token-id files: Parquet list columns with dictionary or delta encoding, small row groups and page indexes.

Files lie in ascending document order.  Each row has the ids of one document, its token count and its offset
inside the file; a manifest gives every file's first global position, so tokens and metadata can be read
selectively (column pruning for metadata, row-group and page statistics on ``doc_id`` for single documents).
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import parts_for, shared_dir

_LOADED: dict[str, WordEncoder] = {}


#: The splitting pattern of the file for lower-case ASCII texts, and for Latin texts up to U+024F, where its
#: numbers beside the digits are the six superscripts and fractions of Latin-1.
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
_LATIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[0-9²³¹¼½¾]|(?:[^\w\s]|_)+")
#: Texts of which Python's lower-casing and classes are known to be the library's.
_PLAIN = re.compile("[\t-\r -~\xa1-\u024f]*")
_SPLIT = ("'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+", ["NFC", "Replace", "Lowercase"])


class _Pieces(dict):
    """Ids of pieces, made by the library's byte mapping and merge model; holds ``most`` at a time."""

    def __init__(self, tokenizer, most: int):
        super().__init__()
        self.mapped, self.merge, self.most = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize, most

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        parts = [piece] if piece.isascii() else [p for p, _ in self.mapped(piece)]
        value = self[piece] = array("i", [t.id for p in parts for t in self.merge(p)]).tobytes()
        return value


class WordEncoder:
    """Ids of a text by a BPE file of the tokenizers library, equal to its ``encode`` without special tokens.

    For a file with the splitting pattern above, the pieces of plain ASCII and Latin texts go through the
    library's merge model once and are kept; ``max_pieces`` bounds what one Python worker keeps.  All other
    texts, those with the string of an added token, and texts of other files, go through the library whole.
    """

    def __init__(self, path: str, max_pieces: int = 500_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        added = spec.get("added_tokens") or []
        self.added = [x["content"] for x in added]
        steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.known = (first.get("pattern", {}).get("Regex"), steps) == _SPLIT and not any(x.get("normalized") for x in added)
        self.pieces = _Pieces(self.tokenizer, max_pieces)

    def packed(self, text: str) -> bytes:
        """Ids of the text as 32-bit integers."""
        if self.known and _PLAIN.fullmatch(text) and not any(x in text for x in self.added):
            if text.isascii():
                return b"".join(map(self.pieces.__getitem__, _ASCII.findall(text.lower())))
            if is_normalized("NFC", text):
                return b"".join(map(self.pieces.__getitem__, _LATIN.findall(text.lower())))
        return array("i", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()


def _encoder(path: str) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path)
    return _LOADED[path]


def write_tokens(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int = 1, encoding: str = "dictionary", file_bytes: int = 16 << 20, row_group_bytes: int = 8 << 20, page_bytes: int = 64 << 10) -> str:
    """Encode whole texts and write them in ascending ``doc_id`` order; returns the folder.

    ``encoding`` is ``dictionary`` or ``delta`` for the id column.  Null texts are empty documents of one end
    id; null document ids come first; repeated rows are written as often as they come.  Rows of one id (or of
    none) lie in the order of a hash of their texts, by which they are also spread over files; only rows equal in
    id and text share a file.  An empty table gives an empty folder of files.  Other columns are not read.
    Spark's writer does the commit, so a retried task leaves no second file.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is dictionary or delta")
    n = parts_for(docs, text, file_bytes)
    dealt = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("_text")]
    dealt = (dealt.repartitionByRange(n, *order) if n > 1 else dealt.coalesce(1)).sortWithinPartitions(*order, "_text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.int32(end_id).tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                piece = batch.slice(lo, 256)
                ids = [encoder.packed(t or "") for t in piece.column("_text").to_pylist()]
                sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4 + 1
                ends = np.cumsum(sizes)
                flat = np.frombuffer(end.join([*ids, b""]), np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(flat))
                yield pa.record_batch([piece.column("doc_id"), pa.array(np.full(len(ids), part, np.int32)), pa.array(at + ends - sizes), pa.array(sizes), lists], ["doc_id", "part", "offset", "n_tokens", "ids"])
                at += int(ends[-1])

    path = shared_dir(docs.sparkSession)
    options = {
        "compression": "zstd",
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.writer.version": "PARQUET_2_0" if encoding == "delta" else "PARQUET_1_0",
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(),
    }
    dealt.mapInArrow(encode, "doc_id long, part int, offset long, n_tokens long, ids array<int>").write.options(**options).parquet(path)
    return path


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``part, base, n_docs, n_tokens``; reads no ids.

    Positions are summed within groups of 1,000 files first, so that the one sort without a partition key has a
    thousandth of the files.
    """
    files = spark.read.parquet(path).groupBy("part").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).withColumn("g", F.expr("part div 1000"))
    so_far = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = files.groupBy("g").agg(F.sum("n_tokens").alias("n_tokens")).select("g", so_far(Window.orderBy("g")).alias("below"))
    inside = files.withColumn("inner", so_far(Window.partitionBy("g").orderBy("part")))
    return inside.join(groups, "g").select("part", (F.col("below") + F.col("inner")).alias("base"), "n_docs", "n_tokens")


def read_tokens(spark: SparkSession, path: str, *, with_ids: bool = True) -> DataFrame:
    """Documents with their global start: ``doc_id, start, n_tokens`` and, if asked for, ``ids``."""
    rows = spark.read.parquet(path)
    bases = manifest(spark, path).select("part", "base")
    # 12 bytes a file: sent to all tasks while the files number a million at most, joined beyond that
    bases = F.broadcast(bases) if bases.count() <= 1_000_000 else bases
    got = rows.join(bases, "part").withColumn("start", F.col("base") + F.col("offset"))
    return got.select("doc_id", "start", "n_tokens", *(["ids"] if with_ids else []))


def with_crc(tokens: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32``: unsigned crc32 of the ids as little-endian 32-bit integers."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            cut, flat = lists.offsets.to_numpy(), np.asarray(lists.values).astype("<u4")
            sums = np.fromiter((zlib.crc32(flat[a:b]) for a, b in zip(cut, cut[1:])), np.int64, batch.num_rows)
            yield pa.record_batch([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
