"""Merkle dataset manifest: a persistent tree whose changed versions copy the ancestors of what changed and share the rest.

Leaves are numbered along their order in a distributed pass and cut into aligned blocks of 8**4 (``height`` 4).  A block is one
small task: it folds its own levels, and its root is a node of the next tree above, which is folded in the same way,
until one node is left.  On the way down every block gets the path above it: for each level its place in its run and
the hashes beside it.  A version in which one leaf has changed shares all nodes of the tree but the leaf's ancestors:
these are copied inside the block, and then on along the path above it, so no task holds the versions of more than
one block.
"""

from __future__ import annotations

import hashlib
import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import ranked
from .common import crc_mod, staged

#: Children of a node.
ARITY = 8
#: The sequence of the subroots.
_ABOVE = "="


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _hash(parts: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def fold(hashes: list[bytes], height: int | None) -> list[list[bytes]]:
    """All levels above ``hashes``: up to one node, or just ``height`` of them."""
    levels = [hashes]
    while len(levels[-1]) > 1 if height is None else len(levels) <= height:
        low = levels[-1]
        levels.append([_hash(low[i : i + ARITY]) for i in range(0, len(low), ARITY)])
    return levels


def path_of(levels: list[list[bytes]], at: int) -> bytes:
    """Each level's place in the run (a byte), number of siblings (a byte) and siblings, from the level of ``at`` up."""
    out = []
    for low in levels[:-1]:
        run = low[at // ARITY * ARITY :][:ARITY]
        place = at % ARITY
        out += [bytes([place, len(run) - 1]), *run[:place], *run[place + 1 :]]
        at //= ARITY
    return b"".join(out)


def climb_path(leaf: bytes, path: bytes) -> list[bytes]:
    """The copied ancestors of a changed node, lowest first."""
    out, at = [leaf], 0
    while at < len(path):
        place, n = path[at], path[at + 1]
        beside = [path[at + 2 + 64 * i :][:64] for i in range(n)]
        out.append(_hash([*beside[:place], out[-1], *beside[place:]]))
        at += 2 + 64 * n
    return out[1:]


def siblings(path: bytes) -> bytes:
    """The hashes of a path alone, in order."""
    out, at = [], 0
    while at < len(path):
        n = path[at + 1]
        out.append(path[at + 2 : at + 2 + 64 * n])
        at += 2 + 64 * n
    return b"".join(out)


def _block(height: int) -> Column:
    return F.floor(F.col("rank") / ARITY**height)


def _sorted(data: pa.Table) -> pa.Table:
    return data.sort_by("rank")


def _levels(data: pa.Table, height: int) -> list[list[bytes]]:
    """Levels of a block: to its top if it is all of its sequence."""
    n = data.column("n")[0].as_py()
    return fold([h.encode() for h in data.column("hash").to_pylist()], None if n <= ARITY**height else height)


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    """``nodes(seq, rank, n, hash)`` of the blocks' roots, ranked by block; ``n`` is the length of the sequence."""

    def root(key: tuple, data: pa.Table) -> pa.Table:
        n = data.column("n")[0].as_py()
        top = _levels(_sorted(data), height)[-1][0].decode()
        return pa.table({"seq": [key[0].as_py()], "rank": [key[1].as_py()], "n": [-(-n // ARITY**height)], "hash": [top]})

    return nodes.select("seq", "rank", "n", "hash", _block(height).alias("block")).groupBy("seq", "block").applyInArrow(root, "seq string, rank long, n long, hash string")


def _paths(nodes: DataFrame, height: int) -> DataFrame:
    """For ``nodes(seq, rank, n, hash)`` of sequences: ``seq, rank, path, top``, the path up to the sequence's top."""
    nodes = staged(nodes)
    if nodes.where("n > 1").isEmpty():
        return nodes.select("seq", "rank", F.lit(b"").alias("path"), F.col("hash").alias("top"))

    def extend(data: pa.Table, above: pa.Table) -> pa.Table:
        data = _sorted(data)
        levels, on, top = _levels(data, height), above.column("path")[0].as_py(), above.column("top")[0].as_py()
        paths = [path_of(levels, i) + on for i in range(data.num_rows)]
        return pa.table([data.column("seq"), data.column("rank"), pa.array(paths, pa.binary()), pa.array([top] * len(paths))], ["seq", "rank", "path", "top"])

    above = _paths(_blocks(nodes, height), height).withColumnRenamed("rank", "block")
    below = nodes.withColumn("block", _block(height))
    return below.groupBy("seq", "block").cogroup(above.groupBy("seq", "block")).applyInArrow(extend, "seq string, rank long, path binary, top string")


def leaf_hashes(docs: DataFrame) -> DataFrame:
    """``doc_id, seq, leaf, tampered``: the leaf of every row of ``docs`` and what it becomes when A-Z in its text are lower-cased.

    ``seq`` is the language, marked so that null comes first; ``tampered`` is null where no change is made: 3 divides
    the crc32 of the changed ids (a null id is left alone).
    """
    leaf = lambda text: F.sha2(F.concat(*[field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)]), 256)
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    seq = F.when(F.col("lang").isNull(), "-").otherwise(F.concat(F.lit("="), "lang"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), seq.alias("seq"), leaf(F.col("text")).alias("leaf"), F.when(crc_mod("doc_id", 3) == 0, leaf(lower)).alias("tampered"))


def manifest(docs: DataFrame, *, height: int = 4, copies: bool = False) -> DataFrame:
    """The manifest of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row.

    Per language, leaves ascend by id and fold by eights to a subroot; subroots fold to the root.  ``folded_root`` is
    the root of the version in which only this row's leaf is replaced by its tampered form (the leaf itself where the
    row is not tampered with).  With ``copies`` a column ``ancestors`` holds the nodes that the version has of its own,
    lowest first; it shares all others.  Blocks have ``height`` levels, which changes no result.  Null fields enter as ``-``; a null language is a sequence of its own and comes
    first; null ids come first in their language and are never tampered with; rows of equal id go by their leaf,
    repeated rows are leaves of their own.  An empty table gives no rows.  Other columns do not matter.
    """
    leaves = staged(leaf_hashes(docs))
    sizes = leaves.groupBy("seq").agg(F.count("*").alias("n"))
    placed = ranked(leaves, ["seq"], ["doc_id", "leaf"])
    placed = staged(placed.join(sizes, "seq").withColumnRenamed("leaf", "hash"))
    inner = staged(_paths(_blocks(placed, height), height).withColumnRenamed("rank", "block"))
    tops = staged(inner.groupBy("seq").agg(F.first("top").alias("hash")))
    count = tops.count()
    roots = ranked(tops, [], ["seq"]).select(F.lit(_ABOVE).alias("seq"), "rank", F.lit(count).cast("long").alias("n"), "hash", F.col("seq").alias("of"))
    roots = staged(roots)
    outer = _paths(roots.drop("of"), height).join(roots.select("rank", "of"), "rank").select(F.col("of").alias("seq"), F.col("path").alias("beyond"), F.col("top").alias("root"))
    above = inner.join(outer, "seq").select("seq", "block", F.concat("path", "beyond").alias("path"), F.col("top").alias("subroot"), "root")

    def finish(data: pa.Table, above: pa.Table) -> pa.Table:
        data = _sorted(data)
        on, subroot, root = (above.column(c)[0].as_py() for c in ("path", "subroot", "root"))
        levels, beside = _levels(data, height), siblings(above.column("path")[0].as_py())
        proofs, folded, kept = [], [], []
        for i, (leaf, tampered) in enumerate(zip(data.column("hash").to_pylist(), data.column("tampered").to_pylist())):
            path = path_of(levels, i)
            proofs.append(hashlib.sha256(siblings(path) + beside).hexdigest())
            line = climb_path((tampered or leaf).encode(), path + on)
            folded.append((line[-1] if line else (tampered or leaf).encode()).decode())
            kept.append([h.decode() for h in line] if tampered else [])
        n = len(proofs)
        cols = [data.column("doc_id"), data.column("hash"), pa.array([subroot] * n), pa.array([root] * n), pa.array(proofs), pa.array(folded), pa.array([f == root for f in folded])]
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        return pa.table([*cols, *([pa.array(kept, pa.list_(pa.string()))] if copies else [])], [*names, *(["ancestors"] if copies else [])])

    made = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean" + ", ancestors array<string>" * copies
    below = placed.withColumn("block", _block(height))
    return below.groupBy("seq", "block").cogroup(above.groupBy("seq", "block")).applyInArrow(finish, made)


def crc_sql(text: str) -> str:
    """DuckDB expression for the unsigned crc32 of an ASCII text, from the polynomial."""
    step = "list_reduce([0::UBIGINT, 1, 2, 3, 4, 5, 6, 7], lambda s, i: xor(s >> 1, (s & 1) * 3988292384::UBIGINT), {0})"
    return f"xor(list_reduce(list_transform(range(length({text})), lambda i: ascii(substr({text}, i::BIGINT + 1, 1))::UBIGINT), lambda a, b: {step.format('xor(a, b)')}, 4294967295::UBIGINT), 4294967295::UBIGINT)"


def _field_sql(value: str) -> str:
    return f"coalesce(octet_length(encode(({value})::VARCHAR))::VARCHAR || ':' || ({value})::VARCHAR, '-')"


def manifest_sql(table: str = "documents") -> str:
    leaf = lambda text: "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    tree = lambda name, base: f"""{name} AS (SELECT 0 AS lvl, seq, pos, n, h FROM {base}
  UNION ALL SELECT lvl + 1, seq, pos // {ARITY}, (n + {ARITY - 1}) // {ARITY}, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY lvl, seq, pos // {ARITY}, n)"""  # noqa: E731
    lift = lambda name, base, over: f"""{name} AS (SELECT 0 AS lvl, row, seq, pos, h FROM {base}
  UNION ALL SELECT s.lvl + 1, s.row, s.seq, s.pos // {ARITY}, sha256(string_agg(CASE WHEN t.pos = s.pos THEN s.h ELSE t.h END, '' ORDER BY t.pos)) FROM {name} s
  JOIN {over} t ON t.n > 1 AND t.lvl = s.lvl AND t.seq = s.seq AND t.pos // {ARITY} = s.pos // {ARITY} GROUP BY s.lvl, s.row, s.seq, s.pos)"""  # noqa: E731
    return f"""
WITH RECURSIVE leaves AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS seq, {leaf('text')} AS leaf,
    CASE WHEN {crc_sql('doc_id::VARCHAR')} % 3 = 0 THEN {leaf(lower)} END AS tampered FROM {table}),
placed AS (SELECT *, row_number() OVER (ORDER BY seq, doc_id NULLS FIRST, leaf) AS row,
    row_number() OVER (PARTITION BY seq ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY seq) AS n FROM leaves),
base AS (SELECT seq, pos, n, leaf AS h FROM placed),
{tree('inside', 'base')},
tops AS (SELECT seq, h FROM inside WHERE n = 1),
heads AS (SELECT '{_ABOVE}' AS seq, row_number() OVER (ORDER BY encode(seq)) - 1 AS pos, count(*) OVER () AS n, h, seq AS lang_seq FROM tops),
{tree('above', 'heads')},
root AS (SELECT h AS root FROM above WHERE n = 1),
changed AS (SELECT row, seq, pos, coalesce(tampered, leaf) AS h FROM placed),
{lift('lifted', 'changed', 'inside')},
own AS (SELECT l.row, max_by(l.h, l.lvl) AS h, any_value(hd.pos) AS pos, '{_ABOVE}' AS seq FROM lifted l JOIN heads hd ON hd.lang_seq = l.seq GROUP BY l.row),
{lift('raised', 'own', 'above')},
ends AS (SELECT row, max_by(h, lvl) AS folded_root FROM raised GROUP BY row),
beside AS (SELECT p.row, 0 AS part, t.lvl, t.pos, t.h FROM placed p JOIN inside t ON t.n > 1 AND t.seq = p.seq
      AND t.pos // {ARITY} = p.pos // (pow({ARITY}, t.lvl + 1)::BIGINT) AND t.pos <> p.pos // (pow({ARITY}, t.lvl)::BIGINT)
  UNION ALL SELECT p.row, 1, t.lvl, t.pos, t.h FROM placed p JOIN heads hd ON hd.lang_seq = p.seq JOIN above t ON t.n > 1
      AND t.pos // {ARITY} = hd.pos // (pow({ARITY}, t.lvl + 1)::BIGINT) AND t.pos <> hd.pos // (pow({ARITY}, t.lvl)::BIGINT)),
proofs AS (SELECT row, string_agg(h, '' ORDER BY part, lvl, pos) AS beside FROM beside GROUP BY row)
SELECT doc_id, leaf, tops.h AS subroot, root, sha256(coalesce(beside, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN tops USING (seq) CROSS JOIN root JOIN ends USING (row) LEFT JOIN proofs USING (row)
"""
