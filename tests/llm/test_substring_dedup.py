import hashlib
import re

import numpy as np
import pyarrow as pa

from geolist.llm import substring_dedup
from geolist.llm.substring_dedup import remove_repeats


def brute(rows, width=13):
    first, docs = {}, []
    for i, text, *_ in rows:
        key = i if i is not None else float("inf")
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        docs.append((i, key, w))
        for j in range(len(w) - width + 1):
            t = tuple(w[j : j + width])
            first[t] = min(first.get(t, key), key)
    out = []
    for i, key, w in docs:
        gone = {k for j in range(len(w) - width + 1) if first[tuple(w[j : j + width])] < key for k in range(j, j + width)}
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i is not None, i or 0, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out)


def test_against_brute_force(docs, doc_rows):
    for size in (1 << 22, 3000):  # one block, then many blocks and buckets
        got = remove_repeats(docs.selectExpr("*", "'x' as kept", "1 as n_words"), block_bytes=size, bucket_bytes=size)
        rows = got.collect()
        assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in rows) == brute(doc_rows)
        assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in rows)


def test_words_decide_where_hashes_clash(docs, doc_rows, monkeypatch):
    real = substring_dedup._windows

    def clashing(words, width):
        start, doc, h = real(words, width)
        return start, doc, h % np.uint64(5)

    monkeypatch.setattr(substring_dedup, "_windows", clashing)
    rows = [r for r in doc_rows if r[0] != 504]
    data = pa.table({"_id": pa.array([r[0] for r in rows], pa.int64()), "_text": pa.array([r[1] for r in rows])})
    b = substring_dedup._Block(data, 13)
    assert len(b.hashes) <= 5
    windows = b.candidates(np.zeros(len(b.hashes), bool))
    names, place, least = b.digests(windows)
    gone = b.start[windows[b.ids[b.doc[windows]] > least[place]]]
    size = int(b.sizes.sum())
    covered = np.cumsum(np.bincount(gone, minlength=size + 1) - np.bincount(gone + 13, minlength=size + 1))[:-1] > 0
    ends = np.cumsum(b.sizes)
    removed = sorted(int(covered[e - n : e].sum()) for e, n in zip(ends, b.sizes))
    assert removed == sorted(r[3] for r in brute(rows))


def test_null_ids_are_dealt_by_text(spark):
    rows = [(None, f"text {k} " + "same words all over " * 9) for k in range(50)] + [(1, "same words all over " * 9)]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=500, bucket_bytes=500).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows)


def test_empty_table(no_docs):
    assert remove_repeats(no_docs).count() == 0
