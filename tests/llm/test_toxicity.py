import numpy as np
import pytest

from geolist.llm import toxicity as t


def make_texts(n, rng):
    texts, labels = [], []
    for i in range(n):
        words = [f"w{rng.integers(400)}" for _ in range(rng.integers(5, 120))]
        bad = i % 3 == 0
        if bad:
            words.insert(int(rng.integers(len(words))), ["scumx", "idiotx", "loserx"][int(rng.integers(3))])
        texts.append(" ".join(words).encode())
        labels.append(int(bad))
    return texts, np.array(labels)


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    model = t.Reader([b"aa", b"bb"], hidden=3, word_dim=3, char_dim=2, attention=3)
    words = [b"aa", b"bb", b"longer"]
    rows, sizes = rng.integers(0, 3, (t.WINDOW, 4)), np.array([24, 5, 1, 0])
    target, weight = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 1, 0.5])
    for k in model.p:
        model.p[k] = model.p[k].astype(np.float64)

    def loss():
        z = model.forward(model.inputs(words)[0].astype(float), rows, sizes).astype(float)
        return float((weight * (np.logaddexp(0, z) - target * z)).mean())

    g = model.gradients(words, rows, sizes, target, weight)
    for k in ("wf", "ub", "bf", "wa", "va", "wo", "bo", "words"):
        flat, own = model.p[k].reshape(-1), np.asarray(g[k]).reshape(-1)
        for i in np.argsort(-np.abs(own))[:3]:
            old = flat[i]
            flat[i] = old + 1e-2
            up = loss()
            flat[i] = old - 1e-2
            down = loss()
            flat[i] = old
            assert own[i] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=2e-5), k


def test_no_byte_of_a_word_is_left_out():
    rng = np.random.default_rng(2)
    model = t.Reader([b"known"])
    alone = b"abcdefghijklmnopqr"
    scores = model.scores([alone + b"stu", alone + b"stv", alone, b"x" * 500 + b"y", b"x" * 501])
    assert len(set(scores.tolist())) == 5
    words = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (1, 2, 3, 17, 24)]
    code, owner = t.word_trigrams(words)
    for i, w in enumerate(words):
        marked = b"\1" + w + b"\2"
        assert code[owner == i].tolist() == [(a * 9973 + b * 613 + c * 31) % t.TRIGRAMS for a, b, c in zip(marked, marked[1:], marked[2:])]
    assert b"".join(t.words_of(b"Ab " + b"Z" * 77)) == b"ab" + b"z" * 77


def plain_score(model, text):
    """The network of one text, window by window and step by step."""
    sig = lambda x: 1 / (1 + np.exp(-x))
    words = t.words_of(text)
    best = -np.inf
    for lo in range(0, max(1, len(words) - t.WINDOW + t.STRIDE), t.STRIDE):
        window = words[lo : lo + t.WINDOW]
        if lo and not window:
            continue
        x = [model.inputs([w])[0][0] for w in window]
        ways = []
        for way in "fb":
            h, out = np.zeros(model.hidden), []
            for v in x if way == "f" else x[::-1]:
                pre, u = v @ model.p[f"w{way}"] + model.p[f"b{way}"], model.p[f"u{way}"]
                n = model.hidden
                z, r = sig(pre[:n] + h @ u[:, :n]), sig(pre[n : 2 * n] + h @ u[:, n : 2 * n])
                h = h + z * (np.tanh(pre[2 * n :] + (r * h) @ u[:, 2 * n :]) - h)
                out.append(h)
            ways.append(out if way == "f" else out[::-1])
        both = np.array([np.concatenate(p) for p in zip(*ways)]).reshape(len(window), 2 * model.hidden)
        near = np.tanh(both @ model.p["wa"] + model.p["ba"]) @ model.p["va"]
        weight = np.exp(near) / np.exp(near).sum()
        best = max(best, float((weight[:, None] * both).sum(0) @ model.p["wo"] + model.p["bo"][0]))
    return sig(best)


def test_scores_against_brute_force():
    rng = np.random.default_rng(9)
    texts, labels = make_texts(60, rng)
    model = t.train_reader(texts, labels, epochs=2)
    more = [t for t in texts[:25]] + [b"one", b"w1 " * 24, b"w1 w2 " * 13, b"long" * 40]
    assert np.allclose(model.scores(more), [plain_score(model, x) for x in more], atol=1e-4)


@pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.01"), reason="needs the given tables")
def test_held_out_labels_of_the_given_tables(spark):
    from geolist.llm.queries import op4_toxicity

    rows = op4_toxicity(spark, "/root/testdata/sf0.01").where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("toxic is not null").select("score", "toxic").collect()
    good, bad = ([r.score for r in rows if r.toxic == y] for y in (0, 1))
    auc = np.mean([(b > g) + (b == g) / 2 for g in good for b in bad])
    assert len(bad) > 5 and auc > 0.75


def test_windows_overlap_and_cover():
    lengths = np.array([0, 1, 24, 25, 100])
    start, size, doc = t.cut_windows(lengths)
    begin = np.cumsum(lengths) - lengths
    for i, n in enumerate(lengths):
        own = [(s - begin[i], z) for s, z, d in zip(start, size, doc) if d == i]
        assert {k for s, z in own for k in range(s, s + z)} == set(range(n)) and own
        assert all(b[0] - a[0] == t.STRIDE for a, b in zip(own, own[1:]))


def test_held_out_accuracy():
    rng = np.random.default_rng(3)
    model = t.train_reader(*make_texts(400, rng), epochs=10)
    texts, labels = make_texts(200, rng)
    assert ((model.scores(texts) >= 0.3) == labels).mean() > 0.95
    both = model.scores([*texts, b"", b" "])
    assert np.allclose(both[:200], model.scores(texts), atol=1e-5) and ((both >= 0) & (both <= 1)).all()


def test_rows_and_empty_tables(spark, docs, no_docs, doc_rows):
    labels = spark.createDataFrame([(r[0], 1, int((r[1] or "").count("***") > 0)) for r in doc_rows], "doc_id long, quality int, toxic int")
    model = t.fit_toxicity(docs, labels)
    got = t.score_toxicity(docs.selectExpr("*", "1 as score"), model).collect()
    assert sorted(map(repr, (r.doc_id for r in got))) == sorted(map(repr, (r[0] for r in doc_rows)))
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    model = t.fit_toxicity(no_docs, labels.limit(0))
    assert t.score_toxicity(no_docs, model).count() == 0
