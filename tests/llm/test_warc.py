import base64
import hashlib
import struct

import zstandard as zs

from geolist.llm import warc


def expected(rows, least=0):
    top = {}
    for i, _, h in rows:
        if i is not None:
            top[h or ""] = max(top.get(h or "", i), i)
    count = {}
    for _, _, h in rows:
        count[h or ""] = count.get(h or "", 0) + 1
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        t = top.get(h or "")
        revisit = len(body) >= least and count[h or ""] > 1 and t is not None and (i is None or i < t)
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", t if revisit else None))
    return sorted(out, key=repr)


def make_rows(n=120):
    rows = [(i, f"http://h{i % 7}.example/{i}", f"<html><body><h1>Title {i}</h1>" + f"<p>common line of text number {i % 5}</p>" * 20 + "</body></html>") for i in range(n)]
    rows += [(n + i, "http://copy.example", rows[3][2]) for i in range(40)]
    return rows + [(900, None, None), (901, "u\r\nX-Evil: 1", ""), (None, "null id", rows[3][2]), (None, "alone", "only once"), (902, "big", "Ü" * 400_000), (903, "same", "tie"), (903, "same", "tie")]


def test_round_trip(spark):
    rows = make_rows()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as size", "'x' as sha")
    for least in (0, 2000):
        path = warc.write_archives(pages, file_bytes=100_000, min_revisit_bytes=least)
        got = warc.read_archives(spark, path)
        assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()), key=repr) == expected(rows, least)
    assert all(f.path.endswith(".warc.zst") for f in spark.read.format("binaryFile").load(path).select("path").collect())
    html = {i: h or "" for i, _, h in rows if i is not None}
    assert all(bytes(r.payload).decode() == html[r.page_id] for r in got.where("record_type = 'response' and page_id is not null").collect())


def test_leading_dictionary_frame_and_single_records(spark):
    pages = spark.createDataFrame(make_rows(), "page_id long, url string, html string")
    path = warc.write_archives(pages)
    data = next(bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect())
    assert data[:4] == struct.pack("<I", 0x184D2A5D)
    size = struct.unpack("<I", data[4:8])[0]
    press = zs.ZstdDecompressor(dict_data=zs.ZstdCompressionDict(data[8 : 8 + size]))
    one = press.decompressobj()
    assert one.decompress(data[8 + size :]).startswith(b"WARC/1.1\r\n") and one.eof


def test_revisits_name_the_record_they_refer_to(spark):
    pages = spark.createDataFrame(make_rows(), "page_id long, url string, html string")
    path = warc.write_archives(pages, file_bytes=50_000, date="2025-02-03T04:05:06Z")
    heads = []
    for r in spark.read.format("binaryFile").load(path).collect():
        for record in warc._records(bytes(r.content)):
            heads.append(dict(x.split(": ", 1) for x in record.partition(b"\r\n\r\n")[0].decode().split("\r\n")[1:] if ": " in x))
    known = {h["WARC-Record-ID"]: h for h in heads}
    revisits = [h for h in heads if h["WARC-Type"] == "revisit"]
    assert len(revisits) > 40
    for h in revisits:
        to = known[h["WARC-Refers-To"]]
        assert to["WARC-Type"] == "response" and to["WARC-Payload-Digest"] == h["WARC-Payload-Digest"]
        assert to["WARC-Target-URI"] == h["WARC-Refers-To-Target-URI"] and h["WARC-Refers-To-Date"] == to["WARC-Date"] == "2025-02-03T04:05:06Z"


def test_few_and_no_records(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(spark, warc.write_archives(empty)).count() == 0
    few = spark.createDataFrame([(1, "u", "a"), (2, "u", "a")], "page_id long, url string, html string")
    assert sorted(r.record_type for r in warc.read_archives(spark, warc.write_archives(few)).collect()) == ["response", "revisit"]


def test_dictionary_from_few_usable_pages_among_many(spark):
    from pyspark.sql import functions as F

    body = F.when(F.col("id") % 3200 == 0, F.concat(F.lit("<html><body>page number "), F.col("id").cast("string"), F.repeat(F.lit(" common words of all pages"), 8), F.lit("</body></html>"))).when(F.col("id") % 2 == 0, "")
    pages = spark.range(640_000).select(F.col("id").alias("page_id"), F.lit("http://x/").alias("url"), body.alias("html"))
    assert len(warc.train_dictionary(pages)) > 500
