"""Log-bilinear language model with noise-contrastive estimation, trained and applied in numpy.

Symbols are the most frequent training tokens and, for all other tokens, kinds by their last two bytes; a kind
spreads its probability over its own tokens by their smoothed counts.  The probability of a symbol is that of its
class times that within its class, both log-bilinear in the two symbols before; classes are runs of the vocabulary
by frequency, and every kind is a class of its own.  So two batched matrix products give the exact normaliser.

Texts are dealt into blocks by their id and written once as numbers, one row a block.  In each round every block
makes one local pass from the common parameters, and Spark sums what the blocks found; all training text takes
part.  A block's pass depends on its own texts only, and the sums are exact, so the model depends neither on how the
input is laid out nor on which task reads what.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, crc_mod, parts_for, planes, staged, unplanes

#: The end of a text, as a token: it has a blank, so no word equals it.
END = b" end"
SMOOTH = 0.1
#: Parameters are handed over in whole multiples of this, so that their weighted sums are exact in any order.
GRAIN = 2.0**-18


def token_kind(token: bytes, kinds: int) -> int:
    return zlib.crc32(token[-2:]) % kinds


def frequency_classes(counts: np.ndarray, classes: int) -> np.ndarray:
    """Where each run of symbols, sorted by falling count, begins, and the end: runs of near equal sums of root counts."""
    if not len(counts):
        return np.zeros(1, np.int64)
    mass = np.cumsum(np.sqrt(counts))
    owner = np.minimum((mass - np.sqrt(counts) / 2) / mass[-1] * classes, classes - 1).astype(np.int64)
    return np.r_[np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]), len(counts)]


@dataclass
class LogBilinear:
    """Parameters: context vectors ``r`` (one more for the start), position weights ``c``; vectors and biases of
    the classes (``q1, b1``) and of the symbols within their class (``q2, b2``)."""

    r: np.ndarray
    c: np.ndarray
    q1: np.ndarray
    b1: np.ndarray
    q2: np.ndarray
    b2: np.ndarray

    @staticmethod
    def start(output: Output, dim: int, order: int = 2, seed: int = 3) -> LogBilinear:
        rng = np.random.default_rng(seed)
        n = lambda *s: 0.1 * rng.standard_normal(s)
        return LogBilinear(n(output.symbols + 1, dim), np.ones((order, dim)), n(len(output.class_p), dim), np.log(output.class_p), n(output.own, dim), np.log(output.inner_p))

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.arrays()])

    def like(self, flat: np.ndarray) -> LogBilinear:
        cuts = np.cumsum([x.size for x in self.arrays()])[:-1]
        return LogBilinear(*(p.reshape(x.shape) for p, x in zip(np.split(flat, cuts), self.arrays())))


class Output:
    """The fixed frame of the output: classes, the unigram of classes and of symbols within theirs, and noise tables."""

    def __init__(self, own_counts: np.ndarray, kind_counts: np.ndarray, classes: int):
        self.own, self.symbols = len(own_counts), len(own_counts) + len(kind_counts)
        self.begins = frequency_classes(own_counts, classes)
        runs = len(self.begins) - 1
        size = np.diff(self.begins)
        self.class_of = np.r_[np.repeat(np.arange(runs), size), runs + np.arange(len(kind_counts))]
        mass = np.bincount(self.class_of, np.r_[own_counts, kind_counts] + 0.5, runs + len(kind_counts))
        self.class_p = mass / mass.sum()
        self.inner_p = (own_counts + 0.5) / mass[self.class_of[: self.own]]
        self.single = np.r_[size == 1, np.ones(len(kind_counts), bool)]
        # each class has a run of slots filled by its symbols in proportion, every symbol once at least
        slots = np.maximum(1, np.round(self.inner_p * 16 * np.repeat(size, size))).astype(np.int64)
        self.slots = np.repeat(np.arange(self.own), slots)
        filled = np.bincount(self.class_of[: self.own], slots, runs) if runs else np.zeros(0)
        self.slot_begin, self.slot_count = (np.cumsum(filled) - filled).astype(np.int64), filled.astype(np.int64)
        self.noise_p = slots / np.repeat(filled, size)


def train(model: LogBilinear, output: Output, target: np.ndarray, context: np.ndarray, *, seed: int, batch: int = 4096, samples: int = 32, ratio: float = 16.0, inner: int = 2, rate: float = 0.2) -> LogBilinear:
    """One pass of noise-contrastive estimation with AdaGrad over classes and over symbols within them.

    The noise classes of a batch are shared by its tokens; within classes each token draws ``inner`` of its own.
    """
    rng = np.random.default_rng(seed)
    r, c, q1, b1, q2, b2 = (x.astype(np.float32) for x in model.arrays())
    grown = [np.full(x.shape, 1e-6, np.float32) for x in (r, c, q1, b1, q2, b2)]
    dim = q1.shape[1]
    shift1 = np.log(ratio * output.class_p).astype(np.float32)
    shift2 = np.log(inner * output.noise_p).astype(np.float32)
    cumulated = np.cumsum(output.class_p)

    lane = np.arange(dim)

    def summed(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
        return np.bincount((index[:, None] * dim + lane).ravel(), rows.ravel(), size * dim).reshape(size, dim)

    for at in range(0, len(target), batch):
        w, h = target[at : at + batch], context[at : at + batch]
        k = output.class_of[w]
        drawn = np.minimum(np.searchsorted(cumulated, rng.random(samples) * cumulated[-1]), len(cumulated) - 1)
        seen = [r[h[:, i]] for i in range(len(c))]
        state = sum(x * ci for x, ci in zip(seen, c))
        qk, qn = q1[k], q1[drawn]
        up = 1 / (1 + np.exp(np.einsum("ij,ij->i", state, qk) + b1[k] - shift1[k]))
        down = (-ratio / samples) / (1 + np.exp(np.clip(shift1[drawn] - b1[drawn] - state @ qn.T, -30, 30)))
        back = up[:, None] * qk + down @ qn
        grads = [None, None, summed(k, up[:, None] * state, len(q1)) + summed(drawn, down.T @ state, len(q1)), np.bincount(k, up, len(q1)) + np.bincount(drawn, down.sum(0), len(q1)), np.zeros_like(q2), np.zeros_like(b2)]
        many = np.flatnonzero(~output.single[k])
        if len(many):
            x, own, kind = state[many], w[many], k[many]
            noise = output.slots[output.slot_begin[kind, None] + (rng.random((len(many), inner)) * output.slot_count[kind, None]).astype(np.int64)]
            every = np.concatenate([own[:, None], noise], 1)
            q = q2[every]
            s = np.einsum("id,ikd->ik", x, q) + b2[every] - shift2[every]
            pull = -1 / (1 + np.exp(np.clip(-s, -30, 30)))
            pull[:, 0] += 1
            back[many] += np.einsum("ik,ikd->id", pull, q)
            grads[4] = summed(every.ravel(), (pull[:, :, None] * x[:, None, :]).reshape(-1, dim), len(q2))
            grads[5] = np.bincount(every.ravel(), pull.ravel(), len(q2))
        grads[0] = sum(summed(h[:, i], back * c[i], len(r)) for i in range(len(c)))
        grads[1] = np.stack([(back * x).sum(0) for x in seen])
        scale = 1.0 / len(w)
        for x, g, s in zip((r, c, q1, b1, q2, b2), grads, grown):
            g = (g * scale).astype(np.float32)
            s += g * g
            x += rate * g / np.sqrt(s)
    return LogBilinear(*(x.astype(np.float64) for x in (r, c, q1, b1, q2, b2)))


def log_probabilities(model: LogBilinear, output: Output, target: np.ndarray, context: np.ndarray, batch: int = 65536, piece: int = 1024) -> np.ndarray:
    """Exact natural log-probability of each symbol after its context.

    Classes are scored for few contexts at a time, so that the products stay in the processor's cache.
    """
    r, c, q1, b1, q2, b2 = (x.astype(np.float32) for x in model.arrays())
    shares = [r * ci for ci in c]  # what a context symbol adds is made once a symbol, not once a token
    every, ones = np.ascontiguousarray(q1.T), np.ones(len(q1), np.float32)

    def log_sum(logit: np.ndarray) -> np.ndarray:
        """The logarithm of the sums of exponentials, in place of ``logit``."""
        top = logit.max(1)
        logit -= top[:, None]
        np.exp(logit, out=logit)
        return np.log(logit @ ones[: logit.shape[1]] if logit.shape[1] <= len(ones) else logit.sum(1)) + top

    out = np.empty(len(target))
    for at in range(0, len(target), batch):
        w, h = target[at : at + batch], context[at : at + batch]
        state = sum(x[h[:, i]] for i, x in enumerate(shares))
        k = output.class_of[w]
        value = np.einsum("ij,ij->i", state, q1[k]) + b1[k]
        for lo in range(0, len(w), piece):
            value[lo : lo + piece] -= log_sum(state[lo : lo + piece] @ every + b1)
        by = np.argsort(k, kind="stable")
        cut = np.searchsorted(k[by], np.arange(len(output.begins)))
        for j in np.flatnonzero((cut[1:] > cut[:-1]) & ~output.single[: len(output.begins) - 1]):
            low, high = output.begins[j : j + 2]
            own, bias = np.ascontiguousarray(q2[low:high].T), b2[low:high]
            for lo in range(cut[j], cut[j + 1], piece):
                rows = by[lo : min(lo + piece, cut[j + 1])]
                inside = state[rows] @ own + bias
                chosen = inside[np.arange(len(rows)), w[rows] - low]
                value[rows] += chosen - log_sum(inside)
        out[at : at + batch] = value
    return out


def contexts(symbols: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
    """The two preceding symbols of every token of texts that lie end to end."""
    begin = np.cumsum(lengths) - lengths
    one = np.r_[start, symbols[:-1]]
    two = np.r_[start, start, symbols[:-2]][: len(symbols)]
    one[begin] = start
    two[begin] = start
    two[(begin + 1)[lengths > 1]] = start
    return np.stack([one, two], 1)


class _Places(dict):
    """Numbers of tokens in the order of their first sight."""

    def __missing__(self, token: bytes) -> int:
        value = self[token] = len(self)
        return value


_BLOCK = "_block int, ids array<long>, held array<boolean>, lengths array<int>, codes binary, words array<binary>, n array<long>"


def _owners(tokens: list[bytes], buckets: int) -> np.ndarray:
    """The bucket that counts each token."""
    return np.fromiter(map(zlib.crc32, tokens), np.int64, len(tokens)) % buckets


def _encode(key: tuple, data: pa.Table) -> pa.Table:
    """One row of a block: its texts in the order of id and text as numbers of its own tokens, and their training counts."""
    bodies, ids, out = column_bytes(data, "_text"), data.column("doc_id").to_pylist(), data.column("held_out").to_pylist()
    order = sorted(range(len(bodies)), key=lambda i: (ids[i] is None, ids[i] or 0, bodies[i]))
    places, codes, lengths = _Places(), [], []
    for i in order:
        tokens = bodies[i].lower().split()
        tokens.append(END)
        codes.append(np.fromiter(map(places.__getitem__, tokens), np.int32, len(tokens)))
        lengths.append(len(tokens))
    held, flat = np.array([out[i] for i in order]), np.concatenate(codes)
    counts = np.bincount(flat[np.repeat(~held, lengths)], minlength=len(places))
    row = [[key[0].as_py()], [[ids[i] for i in order]], [held], [lengths], [flat.tobytes()], [list(places)], [counts]]
    types = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
    return pa.table([pa.array(x, t) for x, t in zip(row, types)], ["_block", "ids", "held", "lengths", "codes", "words", "n"])


def score_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", max_vocabulary: int = 2048, kinds: int = 32, dim: int = 12, rounds: int = 2, hold_out: int = 10, block_bytes: int = 8 << 20) -> DataFrame:
    """Score every whole text: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are A-Z lower-cased words between ASCII white space and one end.  Documents whose id has crc32 modulo
    ``hold_out`` of 0 are held out of counts and training; a null id is never held out.  Null and blank texts are
    one end token.  ``base_score`` is the smoothed unigram log10 probability, ``score`` the model's.  An eighth of
    the types, but 512 at least and ``max_vocabulary`` at most, have vectors of their own, in as many classes as the
    root of their number.  Counts of all distinct tokens stay in Spark: blocks send their tokens in packs to the owner
    of a token's hash, which adds them up and answers each pack with its counts.  Repeated rows count as often as
    they come; rows without an id are dealt by their text; other columns are not read.
    """
    blocks = parts_for(docs, text, block_bytes)
    held = F.coalesce(crc_mod(doc_id, hold_out) == 0, F.lit(False))
    dealt = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text).alias("_text"))
    dealt = dealt.withColumn("_block", F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("_text"))), F.lit(blocks)).cast("int"))
    coded = staged(dealt.groupBy("_block").applyInArrow(_encode, _BLOCK))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, names, n in zip(batch.column("_block").to_pylist(), batch.column("words"), batch.column("n")):
                names, n, rows = names.as_py(), np.asarray(n.values), []
                owner = _owners(names, blocks)
                by = np.argsort(owner, kind="stable")
                cut = np.searchsorted(owner[by], np.arange(blocks + 1))
                for k in np.flatnonzero(cut[1:] > cut[:-1]):
                    own = by[cut[k] : cut[k + 1]]
                    rows.append((int(k), b, b"\n".join([names[i] for i in own]), planes(n[own])))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["bucket", "_block", "words", "n"])

    def add_up(data: pa.Table) -> pa.Table:
        packs = [(b, w.split(b"\n"), unplanes(n, np.int64)) for b, w, n in zip(*(data.column(c).to_pylist() for c in ("_block", "words", "n")))]
        totals: Counter = Counter()
        for _, names, n in packs:
            for w, k in zip(names, n.tolist()):
                totals[w] += k
        rows = [(b, planes(np.fromiter(map(totals.__getitem__, names), np.int64, len(names))), None, None, None, None) for b, names, _ in packs]
        seen = [(w, c) for w, c in totals.items() if c]
        kind = np.fromiter((token_kind(w, kinds) for w, _ in seen), np.int64, len(seen))
        count = np.fromiter((c for _, c in seen), np.int64, len(seen))
        top = sorted(seen, key=lambda x: (-x[1], x[0]))[:max_vocabulary]
        rows.append((None, None, np.bincount(kind, count, kinds).astype(np.int64), np.bincount(kind, minlength=kinds), [w for w, _ in top], [c for _, c in top]))
        types = [pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int64())]
        bucket = pa.array([data.column("bucket")[0].as_py()] * len(rows), pa.int32())
        return pa.table([bucket, *(pa.array(c, t) for c, t in zip(zip(*rows), types))], ["bucket", "_block", "counts", "kind_n", "kind_v", "top", "top_n"])

    packed = coded.select("_block", "words", "n").mapInArrow(pack, "bucket int, _block int, words binary, n binary")
    told = staged(packed.groupBy("bucket").applyInArrow(add_up, "bucket int, _block int, counts binary, kind_n array<long>, kind_v array<long>, top array<binary>, top_n array<long>"))
    sums = told.where("_block is null").agg(*[F.sum(F.col(c)[k]).alias(f"{c}{k}") for c in ("kind_n", "kind_v") for k in range(kinds)]).first()
    kind_n, kind_v = (np.array([sums[f"{c}{k}"] or 0 for k in range(kinds)], float) for c in ("kind_n", "kind_v"))
    n_all, n_types = int(kind_n.sum()), int(kind_v.sum())
    each = told.where("_block is null").select(F.explode(F.arrays_zip("top", "top_n")).alias("t")).select(F.col("t.top").alias("word"), F.col("t.top_n").alias("c"))
    own = each.orderBy(F.desc("c"), "word").limit(min(max_vocabulary, max(512, n_types // 8))).collect()  # the vocabulary: bounded
    for r in own:
        kind_n[token_kind(bytes(r.word), kinds)] -= r.c
        kind_v[token_kind(bytes(r.word), kinds)] -= 1
    output = Output(np.array([float(r.c) for r in own]), kind_n, int(np.ceil(np.sqrt(len(own)))))
    symbol = {bytes(r.word): i for i, r in enumerate(own)}
    model = LogBilinear.start(output, dim)
    start = output.symbols

    def symbols_of(names: list[bytes]) -> np.ndarray:
        """Symbols of distinct tokens."""
        found = (symbol.get(w) for w in names)
        return np.fromiter((len(own) + token_kind(w, kinds) if s is None else s for w, s in zip(names, found)), np.int64, len(names))

    def trainer(model: LogBilinear, turn: int):
        def passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, weight = 0.0, 0.0
            for batch in batches:
                for b, held, lengths, codes, names in zip(*(batch.column(c) for c in ("_block", "held", "lengths", "codes", "words"))):
                    lengths, learns = np.asarray(lengths.values), ~np.asarray(held.values)
                    if not learns.any():
                        continue
                    flat = symbols_of(names.as_py())[np.frombuffer(codes.as_py(), np.int32)]
                    h = contexts(flat, lengths, start)
                    # batches are drawn from the whole block: texts in a drawn order
                    begin = np.cumsum(lengths) - lengths
                    turns = np.random.default_rng([turn, b.as_py()]).permutation(np.flatnonzero(learns))
                    size = lengths[turns]
                    at = np.repeat(begin[turns] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                    new = train(model, output, flat[at], h[at], seed=1000 * turn + b.as_py() % 997, rate=0.2 / (1 + turn))
                    own_weight = -(-len(at) // 4096)
                    total, weight = total + np.round(new.flat() / GRAIN) * GRAIN * own_weight, weight + own_weight
            if weight:
                for i, part in enumerate(np.array_split(total, max(1, len(total) // 4096))):
                    yield pa.record_batch([pa.array([i], pa.int32()), pa.array([part], pa.list_(pa.float64())), pa.array([weight])], ["i", "x", "w"])

        return passes

    def added(data: pa.Table) -> pa.Table:
        x = np.asarray(pa.concat_arrays([c.values if c.offset == 0 else c.flatten() for c in data.column("x").chunks])).reshape(data.num_rows, -1)
        return pa.table([data.column("i")[:1], pa.array([x.sum(0) / sum(data.column("w").to_pylist())], pa.list_(pa.float64()))], ["i", "x"])

    for turn in range(rounds):
        # one row a task and 4096 parameters; one row a 4096 parameters reaches the driver
        passed = coded.select("_block", "held", "lengths", "codes", "words").mapInArrow(trainer(model, turn), "i int, x array<double>, w double")
        mean = passed.groupBy("i").applyInArrow(added, "i int, x array<double>").orderBy("i").collect()
        if mean:
            model = model.like(np.concatenate([r.x for r in mean]))

    spread = kind_n + SMOOTH * (kind_v + 1)
    base_total = n_all + SMOOTH * (n_types + 1)

    def score(key: tuple, data: pa.Table, replies: pa.Table) -> pa.Table:
        columns: list[list] = [[] for _ in range(7)]
        for ids, held, lengths, codes, names in zip(*(data.column(c) for c in ("ids", "held", "lengths", "codes", "words"))):
            lengths, names = np.asarray(lengths.values, dtype=np.int64), names.as_py()
            counts = dict(zip(replies.column("bucket").to_pylist(), replies.column("counts").to_pylist()))
            c = np.empty(len(names))
            c[np.argsort(_owners(names, blocks), kind="stable")] = np.concatenate([unplanes(counts[k], np.int64) for k in sorted(counts)])
            sym = symbols_of(names)
            inner = np.where(sym >= len(own), np.log10((c + SMOOTH) / spread[np.maximum(sym - len(own), 0)]), 0.0)
            base = np.log10((c + SMOOTH) / base_total)
            at = np.frombuffer(codes.as_py(), np.int32)
            flat = sym[at]
            log_p = log_probabilities(model, output, flat, contexts(flat, lengths, start)) / np.log(10) + inner[at]
            begin = np.cumsum(lengths) - lengths
            sums = [np.add.reduceat(x, begin) for x in ((c > 0).astype(np.int64)[at], base[at], log_p)]
            for column, values in zip(columns, (ids.values, held.values, lengths, sums[0], np.full(len(lengths), n_all, np.int64), sums[1], sums[2])):
                column.append(pa.array(values))
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        types = [pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2]
        return pa.table([pa.chunked_array(x, t) for x, t in zip(columns, types)], names)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    replies = told.where("_block is not null").select("_block", "bucket", "counts")
    return coded.drop("n").groupBy("_block").cogroup(replies.groupBy("_block")).applyInArrow(score, schema)
