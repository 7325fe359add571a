"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word enters as the embedding of the word itself, if it is in the vocabulary, beside the mean embedding of
its character trigrams.  The network reads overlapping windows of words; a document scores as its highest
window.  Training treats a labelled document as a bag of windows and learns from the window that scores highest.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, crc_mod

#: Words per window and words between window starts: a passage of up to 17 words lies whole in some window.
WINDOW, STRIDE = 24, 8
#: Longer tokens (texts without blanks, say) are cut into pieces of so many bytes, each a word of its own.
PIECE = 24
#: Hash buckets of character trigrams.
TRIGRAMS = 2048


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of a whole text; none of its bytes is left out."""
    words = text.lower().split()
    if not words or max(map(len, words)) <= PIECE:
        return words
    return [w[i : i + PIECE] for w in words for i in range(0, len(w), PIECE)]


def word_trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all trigrams of each word (with a mark at both ends), end to end, and the word of each."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    marked = np.frombuffer(b"\1" + b"\2\1".join(words) + b"\2", np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(owner)) + 2 * owner
    return (marked[at] * 9973 + marked[at + 1] * 613 + marked[at + 2] * 31) % TRIGRAMS, owner


def cut_windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, real length and document of every overlapping window of texts that lie end to end; at least one each."""
    per = np.maximum(1, -(-(lengths - WINDOW) // STRIDE) + 1)
    doc = np.repeat(np.arange(len(lengths)), per)
    inner = (np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)) * STRIDE
    begin = np.cumsum(lengths) - lengths
    return begin[doc] + inner, np.clip(lengths[doc] - inner, 0, WINDOW), doc


class Reader:
    """The network.  ``p`` holds all parameters by name."""

    def __init__(self, vocabulary: list[bytes], hidden: int = 8, word_dim: int = 10, char_dim: int = 6, attention: int = 8, seed: int = 1):
        rng = np.random.default_rng(seed)
        n = lambda *s, by=0.1: (by * rng.standard_normal(s)).astype(np.float32)
        self.vocabulary = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.hidden = hidden
        d = word_dim + char_dim
        self.p = {"words": n(len(vocabulary) + 1, word_dim), "chars": n(TRIGRAMS, char_dim)}
        for way in "fb":
            self.p |= {f"w{way}": n(d, 3 * hidden, by=0.4), f"u{way}": n(hidden, 3 * hidden, by=0.3), f"b{way}": np.zeros(3 * hidden, np.float32)}
        self.p |= {"wa": n(2 * hidden, attention, by=0.3), "ba": np.zeros(attention, np.float32), "va": n(attention, by=0.3), "wo": n(2 * hidden, by=0.3), "bo": np.zeros(1, np.float32)}

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, tuple]:
        """Input vectors of distinct words."""
        known = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        code, owner = word_trigrams(words)
        count = np.bincount(owner, minlength=len(words))
        mean = np.zeros((len(words), self.p["chars"].shape[1]), np.float32)
        if len(code):
            some = np.flatnonzero(count)
            mean[some] = np.add.reduceat(self.p["chars"][code], (np.cumsum(count) - count)[some])
        count = np.maximum(count, 1)[:, None]
        return np.concatenate([self.p["words"][known], mean / count], 1).astype(np.float32), (known, code, owner, count)

    def _gru(self, pre: np.ndarray, rows: np.ndarray, mask: np.ndarray, way: str, keep: list | None) -> np.ndarray:
        """Hidden states (step, window, hidden); ``pre`` are projected inputs of distinct words."""
        h_size, u = self.hidden, self.p[f"u{way}"]
        h = np.zeros((rows.shape[1], h_size), np.float32)
        out = np.empty((len(rows), *h.shape), np.float32)
        steps = range(len(rows)) if way == "f" else range(len(rows) - 1, -1, -1)
        for t in steps:
            x = pre[rows[t]]
            gates = _sigmoid(x[:, : 2 * h_size] + h @ u[:, : 2 * h_size])
            z, r = gates[:, :h_size], gates[:, h_size:]
            z = z * mask[t][:, None]  # padding keeps the state
            new = np.tanh(x[:, 2 * h_size :] + (r * h) @ u[:, 2 * h_size :])
            if keep is not None:
                keep.append((t, h, z, r, new))
            h = h + z * (new - h)
            out[t] = h
        return out

    def forward(self, x: np.ndarray, rows: np.ndarray, sizes: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows; ``rows`` (step, window) are places in ``x``."""
        mask = (np.arange(len(rows))[:, None] < sizes[None, :]).astype(np.float32)
        traces = {w: [] if keep is not None else None for w in "fb"}
        both = np.concatenate([self._gru(x @ self.p[f"w{w}"] + self.p[f"b{w}"], rows, mask, w, traces[w]) for w in "fb"], 2)
        near = np.tanh(both @ self.p["wa"] + self.p["ba"])
        weight = near @ self.p["va"] + 1e9 * (mask - 1)
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = (weight[:, :, None] * both).sum(0)
        if keep is not None:
            keep |= {"mask": mask, "traces": traces, "both": both, "near": near, "weight": weight, "pooled": pooled}
        return pooled @ self.p["wo"] + self.p["bo"]

    def gradients(self, words: list[bytes], rows: np.ndarray, sizes: np.ndarray, target: np.ndarray, importance: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the weighted logistic loss over a batch of windows."""
        x, (known, code, owner, count) = self.inputs(words)
        k: dict = {}
        logit = self.forward(x, rows, sizes, k)
        p, h_size = self.p, self.hidden
        d = ((_sigmoid(logit) - target) * importance / len(target)).astype(np.float32)
        g = {"wo": k["pooled"].T @ d, "bo": np.array([d.sum()], np.float32)}
        d_pool = d[:, None] * p["wo"]
        d_both = k["weight"][:, :, None] * d_pool
        d_weight = (k["both"] * d_pool).sum(2)
        d_score = k["weight"] * (d_weight - (k["weight"] * d_weight).sum(0))
        g["va"] = np.tensordot(d_score, k["near"], 2)
        d_near = d_score[:, :, None] * p["va"] * (1 - k["near"] ** 2)
        g["wa"] = np.tensordot(k["both"], d_near, ((0, 1), (0, 1)))
        g["ba"] = d_near.sum((0, 1))
        d_both += d_near @ p["wa"].T
        d_x = np.zeros_like(x)
        for n, way in enumerate("fb"):
            u = p[f"u{way}"]
            d_u, d_pre = np.zeros_like(u), np.zeros((len(x), 3 * h_size), np.float32)
            carry = np.zeros((rows.shape[1], h_size), np.float32)
            for t, h, z, r, new in reversed(k["traces"][way]):
                d_h = carry + d_both[t, :, n * h_size : (n + 1) * h_size]
                d_new = d_h * z * (1 - new**2)
                live = np.where(k["mask"][t][:, None] > 0, z, 0.5)
                d_z = d_h * (new - h) * live * (1 - live) * k["mask"][t][:, None]
                d_rh = d_new @ u[:, 2 * h_size :].T
                d_r = d_rh * h * r * (1 - r)
                gates = np.concatenate([d_z, d_r], 1)
                d_u[:, : 2 * h_size] += h.T @ gates
                d_u[:, 2 * h_size :] += (r * h).T @ d_new
                np.add.at(d_pre, rows[t], np.concatenate([gates, d_new], 1))
                carry = d_h * (1 - z) + d_rh * r + gates @ u[:, : 2 * h_size].T
            g[f"u{way}"], g[f"w{way}"], g[f"b{way}"] = d_u, x.T @ d_pre, d_pre.sum(0)
            d_x += d_pre @ p[f"w{way}"].T
        word_dim = p["words"].shape[1]
        g["words"], g["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
        np.add.at(g["words"], known, d_x[:, :word_dim])
        d_char = d_x[:, word_dim:] / count
        np.add.at(g["chars"], code, d_char[owner])
        return g

    def window_logits(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Logits and documents of all overlapping windows of whole texts."""
        words = [words_of(t) for t in texts]
        place: dict[bytes, int] = {}
        for w in words:
            for x in w:
                place.setdefault(x, len(place))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.fromiter((place[x] for w in words for x in w), np.int64, int(lengths.sum()))
        flat = np.concatenate([flat, np.zeros(WINDOW, np.int64)])
        start, size, doc = cut_windows(lengths)
        names = list(place) or [b""]
        x, _ = self.inputs(names)
        pre = {w: x @ self.p[f"w{w}"] + self.p[f"b{w}"] for w in "fb"}
        out = np.empty(len(start), np.float32)
        for lo in range(0, len(start), 4096):
            part = slice(lo, lo + 4096)
            rows = flat[start[part][None, :] + np.arange(WINDOW)[:, None]]
            out[part] = self._logits(pre, rows, size[part])
        return out, doc, (names, flat, start, size)

    def _logits(self, pre: dict[str, np.ndarray], rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        mask = (np.arange(len(rows))[:, None] < sizes[None, :]).astype(np.float32)
        both = np.concatenate([self._gru(pre[w], rows, mask, w, None) for w in "fb"], 2)
        weight = np.tanh(both @ self.p["wa"] + self.p["ba"]) @ self.p["va"] + 1e9 * (mask - 1)
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        return (weight[:, :, None] * both).sum(0) @ self.p["wo"] + self.p["bo"]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of each whole text: that of its highest window."""
        if not texts:
            return np.empty(0)
        logit, doc, _ = self.window_logits(texts)
        top = np.maximum.reduceat(logit, np.searchsorted(doc, np.arange(len(texts))))
        return _sigmoid(top.astype(float))


def train_reader(texts: list[bytes], labels: np.ndarray, *, epochs: int = 10, batch: int = 32, rate: float = 0.01, negative_weight: float = 3.0, max_vocabulary: int = 4000, seed: int = 2) -> Reader:
    """Fit on whole texts with 0/1 labels."""
    seen = [Counter(), Counter()]
    for t, y in zip(texts, labels):
        seen[int(y)].update(set(words_of(t)))
    n1, n0 = int(labels.sum()), int(len(labels) - labels.sum())
    odds = {w: np.log((seen[1][w] + 1) / (n1 + 2)) - np.log((seen[0][w] + 1) / (n0 + 2)) for w, c in (seen[0] + seen[1]).items() if c >= 5}
    vocabulary = sorted(odds, key=lambda w: (-abs(odds[w]) * np.log1p(seen[0][w] + seen[1][w]), w))[:max_vocabulary]
    model = Reader(vocabulary)
    if not n1 or not n0:
        return model
    for w, i in model.vocabulary.items():
        model.p["words"][i, 0] = np.clip(odds[w] / 3, -1.5, 1.5)  # starts from the log-odds of the training labels
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    step = 0
    for epoch in range(epochs):
        logit, doc, (names, flat, start, size) = model.window_logits(texts)
        begin = np.searchsorted(doc, np.arange(len(texts)))
        stop = np.r_[begin[1:], len(doc)]
        if epoch == 0:
            strength = np.array([odds.get(w, 0.0) for w in names])[flat[start[None, :] + np.arange(WINDOW)[:, None]]]
            logit = np.where(np.arange(WINDOW)[:, None] < size[None, :], strength, -9).max(0)
        top = np.array([a + int(np.argmax(logit[a:b])) for a, b in zip(begin, stop)])
        other = begin + (rng.random(len(texts)) * (stop - begin)).astype(np.int64)
        chosen = np.concatenate([top, other[labels == 0]])
        target = np.concatenate([labels, np.zeros(n0)]).astype(np.float32)
        importance = np.where(np.arange(len(chosen)) < len(texts), np.where(target > 0, 1.0, negative_weight), 0.5).astype(np.float32)
        for part in np.array_split(rng.permutation(len(chosen)), max(1, len(chosen) // batch)):
            at = chosen[part]
            rows = flat[start[at][None, :] + np.arange(WINDOW)[:, None]]
            used, rows = np.unique(rows, return_inverse=True)
            g = model.gradients([names[i] for i in used], rows.reshape(WINDOW, len(part)), size[at], target[part], importance[part])
            step += 1
            for k, v in model.p.items():
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
                v -= (rate * 0.9**epoch * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return model


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", hold_out: tuple[int, int] = (4, 2), max_rows: int = 800, max_bytes: int = 32 << 20) -> Reader:
    """Train on at most ``max_rows`` documents of each label and ``max_bytes`` of text (documented bounds), those with the least hash of id.

    Rows whose id has crc32 modulo ``hold_out[0]`` equal to ``hold_out[1]`` give no label; nor do null ids and
    labels.  An id labelled both ways counts as toxic; of an id that comes with several texts the one with the
    least hash is learnt, once.  Null texts are empty.  Inputs are texts only.
    """
    rows = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & (crc_mod(doc_id, hold_out[0]) != hold_out[1]))
    rows = rows.groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("_y"))
    picked = None
    for y in (0, 1):
        some = rows.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
        picked = some if picked is None else picked.union(some)
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(body).alias("h"), body.alias("_text")).join(F.broadcast(picked), "_id")
    sizes = found.groupBy("_id").agg(F.min(F.struct("h", F.octet_length("_text").alias("n"))).alias("m")).select("_id", "m.*", F.xxhash64("_id").alias("draw")).collect()  # 2 * max_rows at most
    chosen, total = [], 0
    for r in sorted(sizes, key=lambda r: (r.draw, r._id)):
        if total + r.n <= max_bytes:
            chosen.append((r._id, r.h))
            total += r.n
    if not chosen:
        return train_reader([], np.zeros(0))
    ids = F.broadcast(docs.sparkSession.createDataFrame(chosen, "_id long, h long"))
    got = found.join(ids, ["_id", "h"]).groupBy("_id", "_y").agg(F.first("_text").alias("_text")).orderBy("_id").toArrow()
    return train_reader(column_bytes(got, "_text"), np.asarray(got.column("_y")))


def score_toxicity(docs: DataFrame, model: Reader, *, doc_id: str = "doc_id", text: str = "text", hold_out: tuple[int, int] = (4, 2), threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every whole text.

    A null or blank text is one empty window and gets the score of no evidence.  A null id is not held out.
    Repeated rows are scored each; other columns are not read.
    """
    held = F.coalesce(crc_mod(doc_id, hold_out[0]) == hold_out[1], F.lit(False))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                piece = batch.slice(lo, 512)
                p = model.scores(column_bytes(piece, "_text"))
                yield pa.record_batch([piece.column("doc_id"), piece.column("held_out"), pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text).alias("_text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
