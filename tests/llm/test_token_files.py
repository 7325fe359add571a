import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from geolist.llm import token_files as t

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_round_trip(spark, docs, doc_rows, encoding):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    want, at = [], 0
    for i, text in sorted(((r[0], r[1] or "") for r in doc_rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*plain.encode(text, add_special_tokens=False).ids, 1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    out = t.write_tokens(docs.selectExpr("*", "'x' as ids", "1 as part"), path, encoding=encoding, file_bytes=20_000)
    got = [tuple(r) for r in t.with_crc(t.read_tokens(spark, out)).orderBy("start").collect()]
    assert got == want
    assert t.read_tokens(spark, out, with_ids=False).columns == ["doc_id", "start", "n_tokens"]
    assert t.manifest(spark, out).count() > 1
    files = [f for f in spark.read.parquet(out).inputFiles()]
    meta = pq.ParquetFile(files[0].removeprefix("file://")).metadata.row_group(0)
    ids = next(meta.column(k) for k in range(meta.num_columns) if meta.column(k).path_in_schema.startswith("ids"))
    assert ids.has_offset_index
    assert ("DELTA_BINARY_PACKED" in ids.encodings) == (encoding == "delta")


def test_words_equal_library_encoding():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, own = Tokenizer.from_file(path), t.WordEncoder(path, max_pieces=3)
    texts = ["", " ", "Don't stop's WE'LL 12a3 ###$$ it’s", "ΑΣ ΟΔΟΣ Ünï İstanbul ß ﬁ é ́a", "a b c\x85d\x1ce", "<|endoftext|> <|startoftext|>x", "a <|endoftext|> b", "a<|endoftext|", "<|ENDOFTEXT|> é", "日本語 テスト emoji 😀😀 ok", "x² ½ª º_a__b µ÷× İX ŉ ǅ Ȼ a\xa0b", "l'été D'ACCORD qu'il's", "tab\tnew\nline\r\n  two"]
    for text in texts:
        assert own.known
        assert own.encode(text) == plain.encode(text, add_special_tokens=False).ids, text


def test_repeated_and_null_ids_are_spread(spark):
    rows = [(None if k % 2 else 7, f"text number {k}") for k in range(400)]
    out = t.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json"), file_bytes=1000)
    got = t.read_tokens(spark, out).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 200 + [7] * 200
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    assert spark.read.parquet(out).groupBy("part").count().agg({"count": "max"}).first()[0] < 150


def test_empty_table(spark, no_docs):
    out = t.write_tokens(no_docs, public_tokenizers.path("word_bpe_49k.json"))
    assert t.with_crc(t.read_tokens(spark, out)).count() == 0
