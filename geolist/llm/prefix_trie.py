"""Trie of conversation prefixes, with subtree totals by time-forward processing.

A prefix is told by two 64-bit words, each the exclusive or of a hash of every turn and its place, so prefixes come
from one pass over sorted ranges and a conversation may be as long as it likes.  A node is named by its depth and the
smallest conversation in it, so the nodes of one conversation form a run; runs (in pieces of ``RUN`` levels) are dealt
to shards.  Within a shard nodes are met in reverse level order, deepest first, and every node sends its total to its
parent through a priority queue, from which the parent takes it when its turn comes; the queue keeps sorted runs on
disk once it is larger than its share of memory.  Nodes whose parent is in another shard are shard roots: their totals
go from root to root, one step a round, summed per receiver before each shuffle, and when all have arrived the shards
are passed once more with what came from outside.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import ranked, running
from .common import crc_mod, staged, words_of

#: Levels of a run that stay together, and conversations whose runs do.
RUN, FAMILY = 4096, 20


class SpillingQueue:
    """Messages ``(key, values)`` taken in ascending order of keys; equal keys are added up.

    Holds ``limit`` messages in memory; beyond that they are sorted and written to a file of the task.
    """

    def __init__(self, width: int, limit: int = 1_000_000):
        self.width, self.limit = width, limit
        self.held: list[np.ndarray] = []
        self.size = 0
        self.runs: list[tuple] = []  # file, rows, next row
        self.spilled = 0

    def push(self, keys: np.ndarray, values: np.ndarray) -> None:
        if len(keys):
            self.held.append(np.column_stack([keys, values]).astype(np.int64))
            self.size += len(keys)
        if self.size > self.limit:
            rows = self._summed(np.concatenate(self.held))
            out = tempfile.TemporaryFile()
            out.write(rows.tobytes())
            self.runs.append([out, len(rows), 0])
            self.held, self.size = [], 0
            self.spilled += 1

    @staticmethod
    def _summed(rows: np.ndarray) -> np.ndarray:
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        head = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
        return np.column_stack([rows[head, 0], np.add.reduceat(rows[:, 1:], head, 0)])

    def _blocks(self, run: list, below: int, rows: int = 65_536) -> Iterator[np.ndarray]:
        """The messages of a run with keys under ``below``, taken off it."""
        width = 8 * (self.width + 1)
        while run[2] < run[1]:
            run[0].seek(run[2] * width)
            block = np.frombuffer(run[0].read(rows * width), np.int64).reshape(-1, self.width + 1)
            n = int(np.searchsorted(block[:, 0], below))
            run[2] += n
            if n:
                yield block[:n]
            if n < len(block):
                return

    def pop(self, below: int) -> tuple[np.ndarray, np.ndarray]:
        """All messages with keys under ``below``: their keys, each once, and the sums of their values."""
        taken = [b for run in self.runs for b in self._blocks(run, below)]
        rest = []
        for rows in self.held:
            mine = rows[:, 0] < below
            taken.append(rows[mine])
            rest.append(rows[~mine])
        self.held = [r for r in rest if len(r)]
        self.size = sum(map(len, self.held))
        rows = np.concatenate(taken) if taken else np.empty((0, self.width + 1), np.int64)
        if not len(rows):
            return rows[:, 0], rows[:, 1:]
        rows = self._summed(rows)
        return rows[:, 0], rows[:, 1:]


def time_forward(parent: np.ndarray, totals: np.ndarray, queue: SpillingQueue, step: int = 65_536) -> np.ndarray:
    """Subtree totals of nodes in processing order; ``parent`` is a later node's place, or -1.

    ``totals`` are the nodes' own values.  Nodes are met in blocks; a block ends before the first parent of one of
    its nodes, so that all messages to a node are in the queue when its turn comes.
    """
    out, lo = totals.copy(), 0
    far = np.where(parent < 0, len(parent), parent)
    while lo < len(parent):
        hi = min(len(parent), lo + step)
        hi = max(lo + 1, min(hi, int(far[lo:hi].min())))
        to, sums = queue.pop(hi)
        out[to] += sums
        sends = np.flatnonzero(parent[lo:hi] >= 0) + lo
        queue.push(parent[sends], out[sends])
        lo = hi
    return out


def _lane(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("pos"), F.col("digest"))


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns ``conv_id, pos, digest, words, last`` of the rebuilt conversations, and ``conv_id, n_turns`` of all.

    Turns go by ``turn`` (null first), equal ones by role and text; null role or text is empty; rows without a
    conversation are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    given = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    # texts decide the order of equal turns only, so only theirs move
    tied = given.groupBy("conv_id", "turn").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv_id").alias("c"), F.col("turn").alias("t"))
    marked = given.join(tied, (F.col("conv_id") == F.col("c")) & F.col("turn").eqNullSafe(F.col("t")), "left")
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 32))
    tie = F.when(F.col("c").isNotNull(), F.struct("role", "text"))
    turns = staged(marked.select("conv_id", "turn", tie.alias("tie"), digest.alias("digest"), F.size(words_of("text")).cast("long").alias("words")))
    own = staged(ranked(turns, ["conv_id"], ["turn", "tie"], "pos").select("conv_id", "pos", "digest", "words"))
    convs = own.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("h", crc_mod("conv_id", 4)).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    convs = staged(convs)
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = staged(convs.withColumn("n_turns", F.col("k") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).select("conv_id", "base", "h", "k", "n_turns"))
    heads = own.where("pos < 3").withColumnRenamed("conv_id", "base")
    taken = convs.where("k > 0").join(heads, "base").where("pos < k")
    kept = own.join(convs, "conv_id").where("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("k"))
    cols = ["conv_id", "pos", "digest", "words", (F.col("pos") == F.col("n_turns") - 1).alias("last")]
    return taken.select(cols).unionByName(kept.select(cols)), convs.select("conv_id", "n_turns")


def _pack(batches: Iterator[pa.RecordBatch], most: int = 2048) -> Iterator[pa.RecordBatch]:
    """Rows ``depth, k1, k2, conv_id``, sorted, become ``depth, k1, k2, first, packed``: up to ``most`` ids of a node in one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([np.asarray(batch.column(c)) for c in ("depth", "k1", "k2")], 1)
        ids = np.asarray(batch.column("conv_id"))
        head = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
        cut = np.concatenate([np.arange(lo, hi, most) for lo, hi in zip(head, np.r_[head[1:], len(ids)])] + [[len(ids)]]).astype(int)
        packed = []
        for lo, hi in zip(cut[:-1], cut[1:]):
            gaps = np.diff(ids[lo:hi]).view(np.uint64)
            width = next(w for w in (1, 2, 4, 8) if w == 8 or gaps.max(initial=0) < 256**w)
            packed.append(bytes([width]) + gaps.astype(f"u{width}").tobytes())
        yield pa.record_batch([*(pa.array(key[cut[:-1], k]) for k in range(3)), pa.array(ids[cut[:-1]]), pa.array(packed, pa.binary())], ["depth", "k1", "k2", "first", "packed"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted packed rows become ``depth, k1, k2, ends_sha256``; a node's ids pass through one hash, packed row by packed row."""
    node, state = None, None
    for batch in batches:
        done = []
        for *key, first, packed in zip(*(batch.column(c).to_pylist() for c in ("depth", "k1", "k2", "first", "packed"))):
            gaps = np.frombuffer(packed[1:], f"u{packed[0]}").astype(np.uint64)
            ids = np.cumsum(np.r_[np.array([first]).view(np.uint64), gaps], dtype=np.uint64).view(np.int64)
            body = ",".join(map(str, ids.tolist())).encode()
            if key == node:
                state.update(b"," + body)
                continue
            if node:
                done.append((*node, state.hexdigest()))
            node, state = key, hashlib.sha256(body)
        yield _named(done)
    if node:
        yield _named([(*node, state.hexdigest())])


def _named(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * 4
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["depth", "k1", "k2", "ends_sha256"])


def _ends(ends: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256`` of the nodes at which conversations end, from ``depth, k1, k2, conv_id``."""
    key = ["depth", "k1", "k2"]
    packed = ends.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInArrow(_pack, "depth long, k1 long, k2 long, first long, packed binary")
    return packed.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(_digests, "depth long, k1 long, k2 long, ends_sha256 string")


def subtree_totals(nodes: DataFrame, names: list[str], *, shard_nodes: int = 200_000, queue: int = 1_000_000) -> DataFrame:
    """Add, for each long column of ``names``, its sum over the node's subtree as ``sub_<name>``.

    ``nodes`` are written rows with ``conv_id, depth``, which tell them apart, and ``parent_conv_id`` (null at a root;
    the parent is one level up).
    """
    shards = max(1, -(-nodes.count() // shard_nodes))
    shard_of = lambda conv, depth: F.pmod(F.xxhash64(F.floor(F.col(conv) / FAMILY), F.floor(depth / RUN)), F.lit(shards)).cast("int")
    owned = nodes.select("conv_id", "depth", "parent_conv_id", *names, shard_of("conv_id", F.col("depth")).alias("shard"))
    width, columns = len(names), nodes.columns

    def arrays(data: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        """The shard in reverse level order, each node's parent as a place in it (-1: elsewhere, or none), and values."""
        data = data.sort_by([("depth", "descending"), ("conv_id", "ascending")])
        conv, depth = np.asarray(data.column("conv_id")), np.asarray(data.column("depth"))
        up = data.column("parent_conv_id").combine_chunks()
        parent = np.full(len(conv), -1, np.int64)
        level = np.flatnonzero(np.r_[True, depth[1:] != depth[:-1], True]) if len(conv) else np.array([0])
        known, above = np.asarray(up.is_valid()), np.asarray(up.fill_null(0))
        for (lo, hi), (lo2, hi2) in zip(zip(level[:-1], level[1:]), zip(level[1:-1], level[2:])):
            if depth[lo2] == depth[lo] - 1:
                at = np.searchsorted(conv[lo2:hi2], above[lo:hi])
                hit = (at < hi2 - lo2) & known[lo:hi]
                hit[hit] = conv[lo2:hi2][at[hit]] == above[lo:hi][hit]
                parent[lo:hi] = np.where(hit, at + lo2, -1)
        values = np.stack([np.asarray(data.column(n).combine_chunks().fill_null(0)) for n in names], 1) if width else np.empty((len(conv), 0), np.int64)
        return data, parent, values

    def roots(data: pa.Table) -> pa.Table:
        """Shard roots with their totals and parents, and the shard root above every node to which others may send."""
        data, parent, values = arrays(data)
        totals = time_forward(parent, values, SpillingQueue(width, queue))
        top = np.arange(len(parent))
        for i in range(len(parent) - 1, -1, -1):
            if parent[i] >= 0:
                top[i] = top[parent[i]]
        conv, depth = np.asarray(data.column("conv_id")), np.asarray(data.column("depth"))
        mine = top == np.arange(len(top))
        sums = [pa.array(totals[:, k]) for k in range(width)]
        flag = pa.array(mine)
        return pa.table([pa.array(conv), pa.array(depth), data.column("parent_conv_id"), pa.array(conv[top]), pa.array(depth[top]), flag, *sums], ["conv_id", "depth", "parent_conv_id", "root_conv", "root_depth", "is_root", *names])

    longs = ", ".join(f"{n} long" for n in names)
    tops = staged(owned.groupBy("shard").applyInArrow(roots, f"conv_id long, depth long, parent_conv_id long, root_conv long, root_depth long, is_root boolean, {longs}"))
    # who a shard root sends to: a node of another shard, and that node's shard root
    sender = tops.where("is_root AND parent_conv_id IS NOT NULL").select(F.col("conv_id").alias("rc"), F.col("depth").alias("rd"), F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"), *names)
    target = tops.select("conv_id", "depth", F.col("root_conv").alias("tc"), F.col("root_depth").alias("td"))
    links = staged(sender.join(target, ["conv_id", "depth"]))
    sums = [F.sum(n).alias(n) for n in names]
    arrived = [links.groupBy("conv_id", "depth").agg(*sums)]
    moving = staged(links.groupBy(F.col("tc").alias("rc"), F.col("td").alias("rd")).agg(*sums))
    while True:
        step = staged(links.drop(*names).join(moving, ["rc", "rd"]))
        if step.isEmpty():
            break
        arrived.append(step.groupBy("conv_id", "depth").agg(*sums))
        moving = staged(step.groupBy(F.col("tc").alias("rc"), F.col("td").alias("rd")).agg(*sums))
    came = arrived[0]
    for more in arrived[1:]:
        came = came.unionByName(more)
    came = came.groupBy("conv_id", "depth").agg(*[F.sum(n).alias(f"_in_{n}") for n in names])
    full = owned.join(came, ["conv_id", "depth"], "left").select("shard", "conv_id", "depth", "parent_conv_id", *[(F.coalesce(n, F.lit(0)) + F.coalesce(f"_in_{n}", F.lit(0))).alias(n) for n in names])

    def finish(data: pa.Table) -> pa.Table:
        data, parent, values = arrays(data)
        totals = time_forward(parent, values, SpillingQueue(width, queue))
        return pa.table([data.column("conv_id"), data.column("depth"), *(pa.array(totals[:, k]) for k in range(width))], ["conv_id", "depth", *[f"sub_{n}" for n in names]])

    done = full.groupBy("shard").applyInArrow(finish, "conv_id long, depth long, " + ", ".join(f"sub_{n} long" for n in names))
    return nodes.join(done, ["conv_id", "depth"]).select(*columns, *[f"sub_{n}" for n in names])


def prefix_trie(conversations: DataFrame, *, shard_nodes: int = 200_000, queue: int = 1_000_000) -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``.  A conversation without turns is a member of the root only.  Null turns come
    first, equal turns go by role and text (repeated rows are turns of their own), null role or text is empty, rows
    with a null conv_id belong to no conversation.  An empty table gives no rows, not even a root.  Prefixes are
    compared by 128 bits.
    """
    turns, convs = rebuilt_turns(conversations)
    turns = staged(turns.withColumn("lane1", _lane(1)).withColumn("lane2", _lane(2)).drop("digest"))
    turns = staged(running(turns, ["conv_id"], ["pos"], {}, {"p1": "lane1", "p2": "lane2"}))
    turns = turns.select("conv_id", (F.col("pos") + 1).alias("depth"), F.col("p1").bitwiseXOR(F.col("lane1")).alias("k1"), F.col("p2").bitwiseXOR(F.col("lane2")).alias("k2"), "p1", "p2", "words", "last")
    zero = F.lit(0).cast("long")
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    top = top.select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"), "conv_id", "n_convs", zero.alias("words"))
    key = ["depth", "k1", "k2"]
    inner = turns.groupBy(*key).agg(F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"))
    nodes = staged(inner.unionByName(top))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    nodes = staged(nodes.join(parents, ["depth", "p1", "p2"], "left"))
    children = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    ended = turns.where("last").select(*key, "conv_id").unionByName(convs.where("n_turns = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id"))
    nodes = nodes.join(children, ["conv_id", "depth"], "left").join(_ends(staged(ended)), key, "left")
    count = F.coalesce("n_children", zero)
    nodes = staged(nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", count.alias("n_children"), F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"), (count == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")))
    done = subtree_totals(nodes, ["leaf", "saved"], shard_nodes=shard_nodes, queue=queue)
    return done.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("sub_leaf").alias("n_leaves"), F.col("sub_saved").alias("saved_tokens"), "ends_sha256")


def prefix_trie_sql(table: str = "conversations") -> str:
    from .merkle import crc_sql

    words = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"
    return f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place FROM {table} WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {crc_sql('conv_id::VARCHAR')} % 4 AS h, conv_id - conv_id % {FAMILY} AS base FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, place, role, text FROM c JOIN t ON t.conv_id = c.base AND place <= h
  UNION ALL SELECT c.conv_id, place, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND place > h),
q AS (SELECT conv_id, row_number() OVER w AS depth, {words} AS words, string_agg(sha256(octet_length(encode(role)) || ':' || role || text), '') OVER (w ROWS UNBOUNDED PRECEDING) AS path
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY place)),
p AS (SELECT conv_id, depth, words, path FROM q UNION ALL SELECT conv_id, 0, 0, '' FROM c),
ends AS (SELECT max_by(path, depth) AS path, conv_id FROM p GROUP BY conv_id),
ended AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM ends GROUP BY path),
n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM p GROUP BY path, depth),
up AS (SELECT n.*, par.conv_id AS parent_conv_id FROM n LEFT JOIN n par ON n.depth > 0 AND par.depth = n.depth - 1 AND par.path = left(n.path, 64 * (n.depth - 1))),
kids AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM up WHERE depth > 0 GROUP BY ALL),
own AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN kids USING (conv_id, depth)),
subtree AS (SELECT a.path, sum((own.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((own.n_convs - 1) * own.words)::BIGINT AS saved_tokens
  FROM own JOIN p a ON a.conv_id = own.conv_id AND a.depth <= own.depth GROUP BY a.path)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM own JOIN subtree USING (path) LEFT JOIN ended USING (path)
"""
