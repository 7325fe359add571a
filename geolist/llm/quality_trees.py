"""Quality rules: document statistics, base rules, and gradient-boosted trees with monotonic constraints.

The trees are complete binary trees kept as flat numpy arrays (feature, threshold, leaf value), so a batch
of documents walks all of them level by level without a Python loop over rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, slices

#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_TAIL = bytes(range(0x80, 0xC0))
_UPPER, _DIGIT, _PUNCT = bytes(range(65, 91)), bytes(range(48, 58)), b"!?.,;:"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Model features and the direction in which the score may move with each (0: free).
FEATURES = {"log_words": 0, "mean_word": 0, "symbol_rate": -1, "dup_line_rate": -1, "repeat_rate": -1, "upper_rate": -1, "digit_rate": -1, "bang_rate": -1, "punct_rate": 0, "distinct_rate": 1, "line_words": 0, "non_ascii_rate": 0}


def text_stats(text: bytes) -> tuple[list[int], list[float]]:
    """Base counts and model features of one whole text (UTF-8 bytes)."""
    words = text.split()
    n = len(words)
    chars = len(text.translate(None, _SPACE + _TAIL))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    triples = list(zip(words, words[1:], words[2:]))
    repeat = 0
    if len(set(triples)) < len(triples):
        seen = Counter(triples)
        reach = 0
        for i, t in enumerate(triples):
            if seen[t] > 1:
                repeat += i + 3 - max(reach, i)
                reach = i + 3
    size = max(1, chars)
    count = lambda s: len(text) - len(text.translate(None, s))
    features = [np.log1p(n), chars / max(1, n), symbols / size, dup / max(1, len(lines)), repeat / max(1, n), count(_UPPER) / size, count(_DIGIT) / size, count(b"!") / size, count(_PUNCT) / size, len(set(words)) / max(1, n), n / max(1, len(lines)), (len(text) - len(text.translate(None, bytes(range(128, 256))))) / max(1, len(text))]
    return [n, chars, symbols, dup, repeat], features


class Trees:
    """Boosted trees for a 0/1 target under logistic loss."""

    def __init__(self, depth: int = 3, rounds: int = 60, rate: float = 0.2, bins: int = 64, ridge: float = 1.0):
        self.depth, self.rounds, self.rate, self.bins, self.ridge = depth, rounds, rate, bins, ridge

    def fit(self, x: np.ndarray, y: np.ndarray, directions: list[int]) -> Trees:
        inner, leaves = 2**self.depth - 1, 2**self.depth
        self.feature = np.zeros((self.rounds, inner), np.int64)
        self.threshold = np.full((self.rounds, inner), np.inf)
        self.value = np.zeros((self.rounds, leaves))
        rate = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        self.base = float(np.log(rate / (1 - rate)))
        if not len(y):
            return self
        cuts = [np.unique(np.quantile(col, np.linspace(0, 1, self.bins + 1)[1:-1])) for col in x.T]
        code = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)])
        score = np.full(len(y), self.base)
        for t in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            low, high = np.full(inner + leaves, -4.0), np.full(inner + leaves, 4.0)
            for k in range(inner):
                rows = np.flatnonzero(node == k)
                best = self._split(code[:, rows], grad[rows], hess[rows], cuts, directions, low[k], high[k])
                left, right = 2 * k + 1, 2 * k + 2
                low[[left, right]], high[[left, right]] = low[k], high[k]
                if best is None:
                    node[rows] = left
                    continue
                f, b, a, c = best
                self.feature[t, k], self.threshold[t, k] = f, cuts[f][b]
                if directions[f]:
                    middle = (a + c) / 2
                    (high if directions[f] > 0 else low)[left] = middle
                    (low if directions[f] > 0 else high)[right] = middle
                node[rows] = np.where(code[f, rows] > b, right, left)
            leaf = node - inner
            g, h = np.bincount(leaf, grad, leaves), np.bincount(leaf, hess, leaves)
            self.value[t] = self.rate * np.clip(g / (h + self.ridge), low[inner:], high[inner:])
            score += self.value[t][leaf]
        return self

    def _split(self, code: np.ndarray, grad: np.ndarray, hess: np.ndarray, cuts: list, directions: list[int], low: float, high: float):
        best, gain = None, 1e-6
        g, h = grad.sum(), hess.sum()
        if len(grad) < 20:
            return None
        for f, cut in enumerate(cuts):
            if not len(cut):
                continue
            gl = np.cumsum(np.bincount(code[f], grad, len(cut) + 1))[:-1]
            hl = np.cumsum(np.bincount(code[f], hess, len(cut) + 1))[:-1]
            a = np.clip(gl / (hl + self.ridge), low, high)
            c = np.clip((g - gl) / (h - hl + self.ridge), low, high)
            parts = lambda v, gg, hh: 2 * v * gg - (hh + self.ridge) * v * v
            whole = np.clip(g / (h + self.ridge), low, high)
            won = parts(a, gl, hl) + parts(c, g - gl, h - hl) - parts(whole, g, h)
            won[(hl < 1e-3) | (h - hl < 1e-3) | (directions[f] * (c - a) < 0)] = 0
            if won.max() > gain:
                b = int(won.argmax())
                best, gain = (f, b, a[b], c[b]), won[b]
        return best

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of target 1."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, cut, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > cut[node])
            total += value[node - len(f)]
        return 1 / (1 + np.exp(-total))


def fit_quality(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = 20_000) -> Trees:
    """Fit on at most ``max_rows`` labelled documents, those with the least hash of their id (documented bound).

    Null ids and labels give no row; an id labelled both ways counts as good.  Of an id that comes more than once
    one row of statistics is learnt, the least.  Null texts are empty.  Other columns are not read.  Without a
    label all documents score one half.
    """
    rows = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("double").alias("_y"))
    picked = rows.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    width = len(FEATURES)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            feats = np.array([text_stats(b)[1] for b in column_bytes(batch, "_text")], float).reshape(-1, width)
            yield pa.record_batch([batch.column("_id"), batch.column("_y"), pa.array(list(feats), pa.list_(pa.float64()))], ["_id", "_y", "_x"])

    found = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text")).join(F.broadcast(picked), "_id").select("_id", "_text", "_y").mapInArrow(measure, "_id long, _y double, _x array<double>")
    got = found.groupBy("_id").agg(F.min(F.struct("_y", "_x")).alias("m")).select("m.*").toArrow()
    x = np.array(got.column("_x").to_pylist(), float).reshape(-1, width)
    y = np.asarray(got.column("_y"))
    order = np.lexsort((*x.T, y)) if len(y) else np.arange(0)
    return Trees().fit(x[order], y[order], list(FEATURES.values()))


def _verdicts(texts: list[bytes], model: Trees, min_words: int, max_repeat_percent: int, min_score: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Base counts, failure of the base rules, tree score and verdict of each text."""
    both = [text_stats(b) for b in texts]
    base = np.array([b for b, _ in both], np.int64).reshape(-1, len(STATS))
    failed = (base[:, 0] < min_words) | (100 * base[:, 4] > max_repeat_percent * base[:, 0])
    score = model.score(np.array([f for _, f in both], float).reshape(-1, len(FEATURES)))
    return base, failed, score, ~failed & (score >= min_score)


def quality_rules(docs: DataFrame, model: Trees, *, doc_id: str = "doc_id", text: str = "text", min_words: int = 50, max_repeat_percent: int = 50, min_score: float = 0.5) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``quality_score`` and ``kept`` for every document.

    A null or empty text has no words and fails the base rules; null ids and repeated rows pass through, one
    result per row; other columns of ``docs`` are not read.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            base, *rest = _verdicts(column_bytes(batch, "_text"), model, min_words, max_repeat_percent, min_score)
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(np.ascontiguousarray(c)) for c in (*base.T, *rest))], ["doc_id", *STATS, "base_failed", "quality_score", "kept"])

    schema = "doc_id long, " + ", ".join(f"{s} long" for s in STATS) + ", base_failed boolean, quality_score double, kept boolean"
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text")).mapInArrow(judge, schema)


def drop_low_quality(docs: DataFrame, model: Trees, *, text: str = "text", min_words: int = 50, max_repeat_percent: int = 50, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, whatever these are called.

    Null and empty texts go, as they have no words; repeated rows and rows with null ids are each judged by
    their text.
    """
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            good = _verdicts(column_bytes(batch, batch.schema.names[at]), model, min_words, max_repeat_percent, min_score)[3]
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
