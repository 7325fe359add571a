import random
from collections import defaultdict

import numpy as np
import pytest

from geolist.llm import rtree_join as rj

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, width=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.replace("\x0b", " ").replace("\x0c", " ").split() if w] if low.isascii() else [w for w in low.replace("\t", " ").replace("\n", " ").split(" ") if w]
    return frozenset([" ".join(words)] if 0 < len(words) < width else [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)])


def brute(rows, percent=90):
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            where[x].append(k)
    for k, (_, s) in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in where[x]:
                if j < k:
                    common[j] += 1
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j][1]) - c):
                a, b = find(j), find(k)
                root[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        if i is not None:
            least[find(k)].append(i)
    return [(i, len(s), (min(least[find(k)], default=None) if s else i)) for k, (i, s) in enumerate(sets)]


def planted(seed=4, bases=60):
    """Texts with words appended, cut off, replaced as a block or scattered, around the limit of 90 percent."""
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(900)]
    rows, at = [], 0
    for b in range(bases):
        words = [rng.choice(vocab) for _ in range(rng.choice([3, 9, 10, 11, 12, 19, 20, 40, 90, 200, 700]))]
        for kind in range(7):
            own, n = list(words), max(1, int(len(words) * rng.choice([0.01, 0.03, 0.05, 0.08, 0.1])))
            if kind == 1:
                own += [rng.choice(vocab) for _ in range(n)]
            elif kind == 2:
                own = own[: len(own) - n]
            elif kind == 3:
                lo = rng.randrange(len(own) - n + 1)
                own[lo : lo + n] = [rng.choice(vocab) for _ in range(n)]
            elif kind == 4:
                for _ in range(max(1, n // 3)):
                    own[rng.randrange(len(own))] = rng.choice(vocab)
            elif kind == 5:
                own = own[n:]
            rows.append((rng.randrange(10**9) if kind else at, " ".join(own) if kind != 6 else " ".join(own).upper(), "en", "s", None))
            at += 1
    return rows


def test_planted_edits_lose_no_link(spark):
    rows = planted()
    got = rj.jaccard_components(spark.createDataFrame(rows, DOCS).repartition(4))
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows))


@pytest.mark.parametrize("percent", [90, 70])
def test_fixture_with_nulls_blanks_and_repeats(spark, docs, doc_rows, percent):
    from pyspark.sql import functions as F

    got = rj.jaccard_components(docs.withColumns({"size": F.lit("x"), "label": F.lit("y")}), percent=percent)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(doc_rows, percent), key=repr)


def test_large_group_and_repeated_rows(spark):
    """A crowd of near copies, a chain of versions, a passage that many share, one row 5,000 times."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(900):
        own = list(base)
        own[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(own), "en", "s", None))
    chain = [f"c{i}" for i in range(100)]
    for i in range(150):
        rows.append((5000 - i, " ".join(chain), "en", "s", None))
        chain[i % 100] = f"d{i}"
    for i in range(300):
        rows.append((8000 + i, " ".join(base[:60] + [f"p{i}_{k}" for k in range(60)]), "en", "s", None))
    rows += [(9999, " ".join(base), "en", "s", None)] * 5000
    got = rj.jaccard_components(spark.createDataFrame(rows, DOCS).repartition(6), chunk=64)
    want = brute(rows[:-4999])
    assert sorted(set(map(tuple, got.collect()))) == sorted(want)


def test_crowded_branch_in_pieces(spark):
    """A branch of several pieces connects labels just as one piece would."""
    from geolist.llm.common import components, staged

    rng = np.random.default_rng(3)
    rows = []
    for c in range(40):
        centre = rng.poisson(4, 64)
        for _ in range(rng.integers(1, 20)):
            own = centre.copy()
            own[rng.integers(0, 64)] += 1
            rows.append((7, len(rows) if c else 0, int(own.sum()), own.astype(np.uint16).view(np.int64).tolist()))
    df = staged(spark.createDataFrame(rows, "bucket long, label long, size long, parity array<long>"))
    roots = [{(r.node, r.root) for r in components(rj.branch_edges(df, 90, exact=True, piece=piece)).collect()} for piece in (10_000, 32)]
    assert roots[0] == roots[1] and len(roots[0]) > 300


def test_tree_finds_what_the_bound_allows():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.poisson(rng.uniform(1, 6), (300, 64)), np.repeat(rng.poisson(3, (5, 64)), 40, 0) + rng.integers(0, 2, (200, 64))]).astype(np.uint16)
    sizes = points.astype(np.int64).sum(1)
    tree = rj.CountTree(points, sizes, 90)
    for k in range(0, 500, 7):
        bound = np.minimum(points[k], points).astype(int).sum(1)
        want = np.flatnonzero((190 * bound >= 90 * (sizes[k] + sizes)) & (100 * sizes >= 90 * sizes[k]) & (90 * sizes <= 100 * sizes[k]))
        assert sorted(tree.order[tree.near(points[k], int(sizes[k]), np.ones(500, bool))]) == want.tolist()
    assert tree.visited < 72 * 500


def test_branches_are_shared_by_all_sets_that_link():
    rng = np.random.default_rng(6)
    for n in (9, 10, 11, 13, 19, 40, 137, 400, 2000):
        for _ in range(20):
            a = rng.integers(0, 2**63, n).astype(np.uint64)
            gone = rng.integers(0, n // 10 + 1)
            new = rng.integers(0, n // 10 + 1)
            b = np.r_[a[gone:], rng.integers(0, 2**63, new).astype(np.uint64)]
            both = n - gone
            if 100 * both >= 90 * (n + new):
                assert gone + new == 0 or np.intersect1d(rj.branches(a, 90), rj.branches(b, 90)).size


def test_empty_table(spark, no_docs):
    assert rj.jaccard_components(no_docs).count() == 0
