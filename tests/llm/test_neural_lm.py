import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from geolist.llm import neural_lm as lm


def tokens(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def test_counts_and_base_score(docs, doc_rows):
    for size in (12 << 20, 5000):
        got = lm.score_documents(docs.selectExpr("*", "1 as word", "2 as score"), block_bytes=size, max_vocabulary=40, rounds=1).collect()
        counts = Counter(t for r in doc_rows if not held(r[0]) for t in tokens(r[1]))
        n, v = sum(counts.values()), len(counts)
        want = []
        for r in doc_rows:
            own = tokens(r[1])
            want.append((r[0] is not None, r[0] or 0, held(r[0]), len(own), sum(counts[t] > 0 for t in own), n, round(sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own), 6)))
        assert sorted((r.doc_id is not None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
        assert all(r.score < 0 for r in got)


def small_output(n=40, kinds=5, classes=6):
    rng = np.random.default_rng(0)
    return lm.Output(np.sort(rng.integers(1, 500, n).astype(float))[::-1], rng.integers(0, 50, kinds).astype(float), classes)


def test_probabilities_are_normalised():
    output = small_output()
    model = lm.LogBilinear.start(output, 4)
    model.r *= 10
    n = output.symbols
    for i, j in [(0, 0), (3, n), (n, n), (n - 1, 7)]:
        log_p = lm.log_probabilities(model, output, np.arange(n), np.tile([i, j], (n, 1)))
        assert abs(np.exp(log_p).sum() - 1) < 1e-5
        # the same, symbol by symbol
        state = model.r[i] * model.c[0] + model.r[j] * model.c[1]
        for w in range(n):
            k = output.class_of[w]
            scores = [state @ model.q1[x] + model.b1[x] for x in range(len(output.class_p))]
            want = scores[k] - math.log(sum(map(math.exp, scores)))
            mates = [x for x in range(output.own) if output.class_of[x] == k]
            if w < output.own:
                inner = {x: state @ model.q2[x] + model.b2[x] for x in mates}
                want += inner[w] - math.log(sum(map(math.exp, inner.values())))
            assert abs(log_p[w] - want) < 1e-4


def test_classes_are_runs():
    for n, classes in ((0, 0), (1, 1), (7, 3), (500, 23)):
        cut = lm.frequency_classes(np.sort(np.random.default_rng(n).integers(1, 9999, n))[::-1], classes)
        assert cut[-1] == n and (np.diff(cut) > 0).all() and len(cut) <= classes + 1


def test_training_learns_the_context():
    rng = np.random.default_rng(1)
    flat = np.empty(60_000, np.int64)
    flat[0] = 0
    for i in range(1, len(flat)):
        flat[i] = (flat[i - 1] + 1) % 12 if rng.random() < 0.9 else rng.integers(12)
    output = lm.Output(np.full(12, 5000.0), np.ones(2), 4)
    h = lm.contexts(flat, np.array([len(flat)]), output.symbols)
    model = lm.LogBilinear.start(output, 8)
    for turn in range(3):
        model = lm.train(model, output, flat, h, seed=turn, batch=1024)
    assert lm.log_probabilities(model, output, flat, h).mean() > math.log(1 / 12) + 1.0


def test_scores_against_brute_force(docs, doc_rows):
    """The score of a text from the model's own parameters, token by token."""
    kept = {}
    real = lm.log_probabilities

    got = {(r.doc_id, r.n_tokens, round(r.base_score, 6)): r.score for r in lm.score_documents(docs, kinds=4, rounds=0).collect()}
    counts = Counter(t for r in doc_rows if not held(r[0]) for t in tokens(r[1]))
    name = lambda t: lm.END if t is None else t.encode()
    own = sorted(counts, key=lambda t: (-counts[t], name(t)))[: max(512, len(counts) // 8)]
    place = {t: i for i, t in enumerate(own)}
    kind_n, kind_v = np.zeros(4), np.zeros(4)
    for t, c in counts.items():
        if t not in place:
            kind_n[lm.token_kind(name(t), 4)] += c
            kind_v[lm.token_kind(name(t), 4)] += 1
    output = lm.Output(np.array([float(counts[t]) for t in own]), kind_n, int(np.ceil(np.sqrt(len(own)))))
    model = lm.LogBilinear.start(output, 12)
    for r in doc_rows:
        t = tokens(r[1])
        if len(t) > 300:
            continue
        s = [place.get(x, len(own) + lm.token_kind(name(x), 4)) for x in t]
        back = [output.symbols, output.symbols, *s]
        log_p = real(model, output, np.array(s), np.array([[back[i + 1], back[i]] for i in range(len(s))]))
        want = log_p.sum() / math.log(10) + sum(math.log10((counts[x] + 0.1) / (kind_n[k] + 0.1 * (kind_v[k] + 1))) for x in t if x not in place for k in [lm.token_kind(name(x), 4)])
        kept[r[0]] = want
        assert any(i == r[0] and n == len(t) and abs(v - want) < 1e-3 for (i, n, _), v in got.items())
    assert len(kept) > 50


def test_scores_do_not_depend_on_the_layout(docs, doc_rows):
    seen = []
    for parts in (1, 8, 32):
        rows = lm.score_documents(docs.repartition(parts), block_bytes=20_000).collect()
        seen.append(sorted(((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.score) for r in rows)))
    assert seen[0] == seen[1] == seen[2]


def test_beats_the_unigram_base_on_held_out_text(spark):
    rows = spark.range(1500).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.when(F.col("id") % 2 == 0, F.lit("en")).otherwise(F.lit("de")), ((i * i + F.col("id")) % 17).cast("string")))).alias("text"))
    got = lm.score_documents(rows, max_vocabulary=64).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got.s > 0.9 * got.b


def test_empty_table(no_docs):
    assert lm.score_documents(no_docs).count() == 0
