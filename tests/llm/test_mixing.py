import math
from collections import defaultdict

import duckdb
import pytest

from geolist.llm import mixing


def key(r):
    return [(x is not None, x) for x in r]


def test_equals_sql(docs):
    frame = docs.where("doc_id is null or doc_id <> 503").toPandas().astype({"doc_id": "Int64"})  # noqa: F841
    want = duckdb.connect().execute(mixing.mix_sql("frame")).fetchall()
    got = mixing.mix(docs.where("doc_id is null or doc_id <> 503").selectExpr("*", "1 as quota", "2 as block")).collect()
    assert sorted(map(key, map(tuple, got))) == sorted(map(key, want))


def test_quotas_are_met(docs):
    rows = mixing.mix(docs, max_repeats=2.0).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    for own in by.values():
        taken, most = sum(r.n_tokens * r.copies for r in own), max(r.n_tokens for r in own)
        assert own[0].quota <= taken < own[0].quota + most
        assert own[0].quota <= 2.0 * sum(r.n_tokens for r in own) + 1


def test_entropy_target(docs):
    rows = mixing.mix(docs, max_repeats=None, min_entropy=1.2).collect()
    quota = {r.source: r.quota for r in rows}
    total = sum(quota.values())
    assert -sum(q / total * math.log(q / total) for q in quota.values() if q) >= 1.2 - 1e-3
    with pytest.raises(ValueError):
        mixing.mix(docs, max_repeats=None)


def test_empty_table(no_docs):
    assert mixing.mix(no_docs).count() == 0
