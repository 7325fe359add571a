import re
from collections import Counter

import numpy as np

from geolist.llm import quality_trees as q


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if wins[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def labels_for(spark, rows):
    return spark.createDataFrame([(r[0], int((r[1] or "").count("*") < 2), 0) for r in rows], "doc_id long, quality int, toxic int")


def test_counts_and_verdict(spark, docs, doc_rows):
    model = q.fit_quality(docs, labels_for(spark, doc_rows))
    extra = docs.selectExpr("*", "1 as n_words", "true as kept")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in q.quality_rules(extra, model).collect())
    want = []
    for i, text, *_ in doc_rows:
        p = plain(text)
        want.append((i is not None, i or 0, *p, p[0] < 50 or 100 * p[4] > 50 * p[0]))
    assert got == sorted(want)


def test_empty_tables(spark, no_docs):
    model = q.fit_quality(no_docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert q.quality_rules(no_docs, model).count() == 0


def test_monotone_and_learns():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] < 0.5) & (x[:, 1] + 0.1 * rng.standard_normal(3000) > 0.3)).astype(float)
    model = q.Trees().fit(x, y, [-1, 1, 0])
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    grid = np.linspace(0, 1, 200)
    for other in rng.random((20, 3)):
        line = np.tile(other, (200, 1))
        line[:, 0] = grid
        assert (np.diff(model.score(line)) <= 1e-12).all()
        line = np.tile(other, (200, 1))
        line[:, 1] = grid
        assert (np.diff(model.score(line)) >= -1e-12).all()


def walked(model, x):
    """Score of one document, node by node."""
    total = model.base
    for f, cut, value in zip(model.feature, model.threshold, model.value):
        node = 0
        while node < len(f):
            node = 2 * node + (2 if x[f[node]] > cut[node] else 1)
        total += value[node - len(f)]
    return 1 / (1 + np.exp(-total))


def test_verdict_against_a_walk_through_the_trees(spark, docs, doc_rows):
    model = q.fit_quality(docs, labels_for(spark, doc_rows))
    want = []
    for i, text, *_ in doc_rows:
        (n, *_, repeat), x = q.text_stats((text or "").encode())
        score = walked(model, x)
        want.append((i is not None, i or 0, round(score, 9), bool(n >= 50 and 100 * repeat <= 50 * n and score >= 0.5)))
    got = q.quality_rules(docs, model).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, round(r.quality_score, 9), r.kept) for r in got) == sorted(want)
    left = q.drop_low_quality(docs, model).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in left) == sorted(w[:2] for w in want if w[3])
    assert 0 < len(left) < len(doc_rows)
