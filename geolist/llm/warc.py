"""Dictionary-compressed WARC archives: a leading skippable frame holds the Zstandard dictionary, every record
is a frame of its own, and records with equal payloads become revisits of one response.

Archives are written by Spark's own text writer, one frame a row, so the commit protocol, retries and any
file system come for free: frames are handed over as raw bytes, and the row separator is itself an empty
skippable frame, which every Zstandard reader passes over.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_bytes, parts_for, shared_dir, staged

#: Skippable frame that carries the dictionary of a WARC file, and the one that separates rows (both fixed values).
DICT_MAGIC = struct.pack("<I", 0x184D2A5D)
GAP = "P*M\x18\x00\x00\x00\x00"
_NO_ID = -(1 << 63)


def train_dictionary(pages: DataFrame, *, page_id: str = "page_id", html: str = "html", max_records: int = 1000, max_bytes: int = 16 << 20, size: int = 64 << 10) -> bytes:
    """A dictionary from at most ``max_records`` distinct records (least hash of id and payload) and ``max_bytes`` of them.

    Records are chosen by hashes and lengths alone, as a bounded top list over all of them at every size; only
    payloads that are chosen move.  Null and empty pages are no records.  Fewer than 8 usable records give an empty
    dictionary: the records are then compressed without one.
    """
    full = pages.where(F.octet_length(html) > 0).select(F.col(page_id).cast("long").alias("i"), F.xxhash64(html).alias("h"), F.col(html).cast("binary").alias("body"))
    short = full.select("i", "h", F.length("body").alias("n"), F.xxhash64("i", "h").alias("draw"))
    chosen, total = [], 0
    for r in short.select("draw", "i", "h", "n").distinct().orderBy("draw", "i", "h").limit(max_records).collect():  # four numbers a record
        if total + r.n <= max_bytes:
            chosen.append((r.i, r.h))
            total += r.n
    if len(chosen) < 8:
        return b""
    picked = F.broadcast(pages.sparkSession.createDataFrame(chosen, "ci long, ch long"))
    found = full.join(picked, F.col("i").eqNullSafe(F.col("ci")) & (F.col("h") == F.col("ch"))).select("i", "h", "body")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # of the chosen records
        for batch in batches:
            keys = list(zip(batch.column("i").to_pylist(), batch.column("h").to_pylist()))
            new = [k for k, x in enumerate(keys) if x not in seen and not seen.add(x)]
            yield batch.take(pa.array(new, pa.int64()))

    bodies = {(r.i, r.h): bytes(r.body) for r in found.mapInArrow(once, found.schema).dropDuplicates(["i", "h"]).collect()}
    try:
        return zs.train_dictionary(min(size, total // 10), [bodies[k] for k in chosen], level=3).as_bytes()
    except zs.ZstdError:
        return b""


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{digest}')}>"


def _header(page_id: int | None, url: str, date: str, digest: str, refers: int | None, refers_url: str | None, length: int, payload_bytes: int) -> bytes:
    kind = "response" if refers is None else "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {date}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-Id: {'' if page_id is None else page_id}", f"X-Payload-Bytes: {payload_bytes}"]
    if refers is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers, digest)}", f"WARC-Refers-To-Target-URI: {refers_url}", f"WARC-Refers-To-Date: {date}", f"X-Refers-To-Page: {refers}"]
    return "\r\n".join([*lines, "Content-Type: text/html", f"Content-Length: {length}", "", ""]).encode()


def _name_archives(spark: SparkSession, path: str) -> None:
    """Rename the committed files to ``.warc.zst``, through Hadoop's file system, so for any store."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        if name.endswith(".txt"):
            files.rename(entry.getPath(), spark._jvm.org.apache.hadoop.fs.Path(folder, name.removesuffix(".txt") + ".warc.zst"))


def write_archives(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", min_revisit_bytes: int = 0, file_bytes: int | None = None, level: int = 3, date: str | None = None) -> str:
    """Write every row as a record and return the folder of ``.warc.zst`` archives.

    Null html is an empty payload.  Among records with equal payloads of at least ``min_revisit_bytes`` bytes,
    those with the largest page id are responses and the others revisit it; a null page id revisits any other.
    Line breaks in a url are dropped; a null url is empty.  Records are dated ``date`` (ISO 8601, UTC), by default
    the time of the call: pages carry no time of capture.  ``file_bytes`` of payloads go into an archive, by
    default a thousandth of all, but 16 MB at least and 256 MB at most.  An empty table gives an archive with a
    dictionary frame only, or none.  Other columns are not read.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    dictionary = train_dictionary(pages, page_id=page_id, html=html)
    total = parts_for(pages, html, 1)
    n = -(-total // (file_bytes or min(max(total // 1000, 16 << 20), 256 << 20)))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.regexp_replace(F.coalesce(F.col(url), F.lit("")), "[\r\n]+", "").alias("url"), F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload")).withColumn("sha", F.sha1("payload")).withColumn("key", F.coalesce("page_id", F.lit(_NO_ID)))
    # which rows revisit is found on ids, urls and hashes alone; a hot payload is many short rows here
    keys = rows.where(F.length("payload") >= min_revisit_bytes).select("key", "sha", "url")
    groups = staged(keys.groupBy("sha").agg(F.max(F.struct("key", "url")).alias("top"), F.count("*").alias("n")).where(F.col("n") > 1).where(F.col("top.key") != _NO_ID).select("sha", F.col("top.key").alias("top"), F.col("top.url").alias("top_url")))
    revisits = staged(keys.select("key", "sha").join(groups, "sha").where(F.col("key") < F.col("top")).distinct())
    # then each payload moves once, dealt by its own id
    rows = rows.repartition(n, "key", "sha").join(revisits, ["key", "sha"], "left")
    rows = rows.select("page_id", "url", F.when(F.col("top").isNull(), F.col("payload")).alias("payload"), F.length("payload").alias("size"), "sha", F.col("top").alias("refers"), "top_url")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = zs.ZstdCompressionDict(dictionary) if dictionary else None
        press = zs.ZstdCompressor(level=level, dict_data=trained, write_checksum=True, write_content_size=True)
        first = DICT_MAGIC + struct.pack("<I", len(dictionary)) + dictionary
        for batch in batches:
            out = []
            plain = [batch.column(c).to_pylist() for c in ("page_id", "url", "size", "sha", "refers", "top_url")]
            for i, link, size, sha, to, to_url, body in zip(*plain, column_bytes(batch, "payload")):
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                record = _header(i, link, date, digest, to, to_url, len(body), size) + body + b"\r\n\r\n"
                out.append(first + press.compress(record))
                first = b""
            yield pa.record_batch([pa.array(out, pa.binary())], ["frame"])

    path = shared_dir(pages.sparkSession)
    dealt = rows.mapInArrow(frames, "frame binary")
    dealt.select(F.col("frame").cast("string")).write.option("lineSep", GAP).text(path)
    _name_archives(pages.sparkSession, path)
    return path


_FRAME = struct.Struct("<II")


def _records(data: bytes) -> Iterator[bytes]:
    """Decoded records of one archive, from its bytes alone."""
    at, press = 0, zs.ZstdDecompressor()
    while at < len(data):
        magic, size = _FRAME.unpack_from(data, at) if at + 8 <= len(data) else (0, 0)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if data[at : at + 4] == DICT_MAGIC and size:
                press = zs.ZstdDecompressor(dict_data=zs.ZstdCompressionDict(data[at + 8 : at + 8 + size]))
            at += 8 + size
            continue
        one, parts = press.decompressobj(), []
        while not one.eof:  # a frame does not tell its compressed length: feed it in small steps
            if at >= len(data):
                raise ValueError("the archive ends inside a record")
            parts.append(one.decompress(data[at : at + 8192]))
            at = min(at + 8192, len(data))
        at -= len(one.unused_data)
        yield b"".join(parts)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives: ``page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to``.

    Responses are measured and hashed as read.  The payload of a revisit is null; its size and digest are those
    it carries of the response it names.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
    types = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in column_bytes(batch, "content"):
                rows: list[tuple] = []
                for record in _records(data):
                    head, _, rest = record.partition(b"\r\n\r\n")
                    field = dict(x.split(":", 1) for x in head.decode().split("\r\n")[1:])
                    value = {k: v.strip() for k, v in field.items()}
                    kind, body = value["WARC-Type"], rest[: int(value["Content-Length"])]
                    page = int(value["X-Page-Id"]) if value["X-Page-Id"] else None
                    if kind == "response":
                        rows.append((page, value["WARC-Target-URI"], kind, body, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), None))
                    else:
                        rows.append((page, value["WARC-Target-URI"], kind, None, int(value["X-Payload-Bytes"]), value["WARC-Payload-Digest"].removeprefix("sha1:"), int(value["X-Refers-To-Page"])))
                    if len(rows) == 512:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows = []
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return files.mapInArrow(parse, "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long")
