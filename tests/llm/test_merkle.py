import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest

from geolist.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, text):
    return h(*(field(v) for v in (row.doc_id, row.source, row.lang, row.n_chars, text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def brute(rows):
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r.lang].append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    inner = {x: tree([v[2] for v in sorted(by_lang[x], key=lambda v: v[:3])]) for x in langs}
    outer = tree([inner[x][-1][0] for x in langs]) if langs else []
    out = []
    for k, x in enumerate(langs):
        for i, (_, _, own, r) in enumerate(sorted(by_lang[x], key=lambda v: v[:3])):
            lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text) if r.text is not None else None
            new = leaf(r, lower) if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 else own
            proof = []
            for levels, at in ((inner[x], i), (outer, k)):
                for low in levels[:-1]:
                    lo = at // 8 * 8
                    run = low[lo : lo + 8]
                    proof += run[: at - lo] + run[at - lo + 1 :]
                    run[at - lo] = new
                    new, at = h(*run), at // 8
            out.append((r.doc_id, own, inner[x][-1][0], outer[-1][0], h(*proof), new, new == outer[-1][0]))
    return out


NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("height", [1, 4])
def test_against_brute_force(spark, docs, height):
    """With blocks of one level a tree of 70 leaves has several block levels."""
    more = docs.unionByName(spark.createDataFrame([(7000 + i, "A", f"l{i:02d}", "s", i) for i in range(20)], DOCS)).unionByName(docs.where("doc_id < 100"))
    got = merkle.manifest(more.withColumn("rank", docs_clash()).withColumn("hash", docs_clash()), height=height)
    assert got.columns == NAMES
    want = brute(more.collect())
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert len({w[6] for w in want}) == 2


def docs_clash():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_copied_ancestors_end_in_the_versions_root(spark, docs):
    for r in merkle.manifest(docs, copies=True).collect():
        assert not r.ancestors or r.ancestors[-1] == r.folded_root
        assert r.ancestors or r.verified


def test_small_tables(spark, no_docs):
    assert merkle.manifest(no_docs).count() == 0
    one = spark.createDataFrame([(3, None, None, None, None)], DOCS)
    assert list(map(tuple, merkle.manifest(one).collect())) == brute(one.collect())


def test_sql_says_the_same(spark, docs):
    rows = docs.where("length(text) < 5000 or text is null").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [list(r) for r in rows])
    got = con.execute(merkle.manifest_sql()).fetchall()
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
