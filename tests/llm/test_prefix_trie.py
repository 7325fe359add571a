import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from geolist.llm import prefix_trie as pt

CONV = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - int(np.fmod(c, 20)), [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        words = len([w for w in node[-1][1].replace("\x0b", " ").split()]) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids[node])
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in m if len(built[c]) == len(node))
        out.append((m[0], len(node), members[node[:-1]][0] if node else None, len(m), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def make(seed=2):
    rng = random.Random(seed)
    words = ["a", "b c", "d\te  f", "", None, " ", "ü x"]
    rows = []
    for c in [*range(1, 260), -7, -40, 10**15]:
        if c in (20, 60):
            continue  # bases that are absent
        for t in range(rng.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, rng.choice([t, t, t, None, 2]), rng.choice(["user", "user", "assistant", None]), rng.choice(words)))
    rows += [(300 + i, 0, "user", "hello there") for i in range(1500)]  # copies: a third of all rows and more
    rows += [(77, 50 + t, "user", f"long {t % 3}") for t in range(700)]  # one long conversation
    rows += [(177, 50 + t, "user", f"long {t % 3}") for t in range(700)]
    rows += [(5, 1, "user", "again")] * 3 + [(None, 1, "user", "nobody")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return make()


@pytest.mark.parametrize("options", [{}, {"shard_nodes": 300, "queue": 50}])
def test_against_brute_force(spark, rows, options):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, CONV).repartition(5).withColumns({"pos": F.lit("x"), "depth": F.lit(1), "n": F.lit(2)})
    got = pt.prefix_trie(df, **options)
    assert got.columns == NAMES
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows), key=repr)


def test_small_tables(spark):
    assert pt.prefix_trie(spark.createDataFrame([], CONV)).count() == 0
    one = [(21, None, None, None)]
    assert sorted(map(tuple, pt.prefix_trie(spark.createDataFrame(one, CONV)).collect())) == sorted(brute(one))


def test_queue_spills_and_adds_up():
    rng = np.random.default_rng(1)
    n = 20_000
    parent = np.minimum(np.arange(n) + rng.integers(1, 500, n), n)
    parent = np.where(parent == n, -1, parent)
    own = rng.integers(0, 100, (n, 2))
    queue = pt.SpillingQueue(2, 64)
    got = pt.time_forward(parent, own, queue, step=100)
    want = own.copy()
    for i in range(n):
        if parent[i] >= 0:
            want[parent[i]] += want[i]
    assert queue.spilled > 10 and (got == want).all()


def test_sql_says_the_same(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [list(r) for r in rows])
    res = con.execute(pt.prefix_trie_sql())
    assert [d[0] for d in res.description] == NAMES
    assert sorted(res.fetchall(), key=repr) == sorted(brute(rows), key=repr)
