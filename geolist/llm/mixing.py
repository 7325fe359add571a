"""Temperature mixing of sources to target weights, with DataFrame functions only.

Source token shares are raised to an exponent in [0, 1] and normalised; the exponent is bisected to the
flattest mix that keeps a repetition limit (or to a target entropy).  The weights become token quotas of a
budget.  A source's quota is whole passes over it plus one partial pass, taken from its documents in a
pseudo-random order of blocks until the rest of the quota is filled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, words_of

#: The exponent is a whole number of these steps, so any engine that bisects finds the same one.
STEPS = 4096


def _draw(*parts: Column | str) -> Column:
    """A number below 2**60 from the MD5 of the parts, the same in every SQL engine."""
    joined = F.concat_ws("|", *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def find_exponent(sources: DataFrame, budget: int, *, max_repeats: float | None, min_entropy: float | None = None) -> int:
    """Bisect the exponent (in steps of 1/4096) over ``sources(source, tokens)``.

    With ``max_repeats``: the least exponent at which no source is repeated more often; 4096 (the natural
    shares) if none is low enough.  With ``min_entropy`` (nats): the largest exponent whose mix has at least
    that entropy; 0 if none has.  Each probe is one aggregate over the source table; sources without tokens
    take no part.
    """
    if (max_repeats is None) == (min_entropy is None):
        raise ValueError("give either max_repeats or min_entropy")
    live = sources.where("tokens > 0")
    low, high = 0, STEPS
    while low < high:
        middle = (low + high + (max_repeats is None)) // 2
        power = F.pow(F.col("tokens").cast("double"), F.lit(middle / STEPS))
        probe = live.select("tokens", power.alias("p")).agg(F.sum("p").alias("z"), F.max(F.col("p") / F.col("tokens")).alias("top"), F.sum(F.col("p") * F.log("p")).alias("plogp")).first()
        if probe.z is None:
            return STEPS
        if max_repeats is not None:
            good = probe.top / probe.z * budget <= max_repeats
            low, high = (low, middle) if good else (middle + 1, high)
        else:
            import math

            good = math.log(probe.z) - probe.plogp / probe.z >= min_entropy
            low, high = (middle, high) if good else (low, middle - 1)
    return low


def _with_copies(docs: DataFrame, rows: DataFrame, *, budget_share: float, max_repeats: float | None, min_entropy: float | None, seed: int) -> DataFrame:
    """``docs(doc_id, source, n_tokens, draw, ...)`` with ``exponent, quota, block, copies``; ``rows`` has the same first four."""
    sources = staged(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs")))
    budget = int(budget_share * (sources.agg(F.sum("tokens")).first()[0] or 0))
    step = find_exponent(sources, budget, max_repeats=max_repeats, min_entropy=min_entropy)
    power = F.pow(F.col("tokens").cast("double"), F.lit(step / STEPS))
    z = sources.agg(F.sum(power)).first()[0] or 1.0
    quotas = sources.select(
        F.col("source").alias("_s"),
        "tokens",
        F.floor(F.round(power / F.lit(z) * F.lit(float(budget)), 3)).cast("long").alias("quota"),
        F.ceil(F.sqrt("n_docs")).cast("long").alias("n_blocks"),
    ).select("*", F.expr("quota div tokens").alias("passes"), F.expr("quota % tokens").alias("rest"))
    number = F.coalesce(F.col("doc_id").cast("string"), "draw")

    def placed(df: DataFrame) -> DataFrame:
        return df.join(quotas, F.col("source").eqNullSafe(F.col("_s"))).withColumn("block", _draw(F.lit(f"{seed}|block"), number) % F.col("n_blocks"))

    sums = placed(rows).groupBy("source", "block").agg(F.sum("n_tokens").alias("block_tokens")).withColumn("turn", _draw(F.lit(f"{seed}|turn"), F.coalesce("source", F.lit("")), F.col("block").cast("string")))
    before = Window.partitionBy("source").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, -1)
    filled = sums.select(F.col("source").alias("_s2"), F.col("block").alias("_b"), F.coalesce(F.sum("block_tokens").over(before), F.lit(0)).alias("filled"))
    both = placed(docs).join(filled, F.col("source").eqNullSafe(F.col("_s2")) & (F.col("block") == F.col("_b")))
    inside = Window.partitionBy("source", "block").orderBy(_draw(F.lit(f"{seed}|doc"), number), "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    taken = both.withColumn("upto", F.col("filled") + F.sum("n_tokens").over(inside) - F.col("n_tokens"))
    return taken.withColumn("exponent", F.lit(step / STEPS)).withColumn("copies", F.col("passes") + (F.col("upto") < F.col("rest")).cast("long"))


def _measured(docs: DataFrame, doc_id: str, text: str, source: str, *more) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.greatest(F.size(words_of(text)), F.lit(1)).cast("long").alias("n_tokens"), F.when(F.col(doc_id).isNull(), F.md5(F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8"))).alias("draw"), *more)


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", budget_share: float = 1.0, max_repeats: float | None = 1.5, min_entropy: float | None = None, seed: int = 17) -> DataFrame:
    """Per document: ``doc_id, source, n_tokens, exponent, quota, block, copies``.

    Tokens are words between ASCII white space; a text without words counts one token.  ``budget_share`` of all
    tokens is the budget.  ``copies`` is how often the mix takes the document; the copies of a source hold its
    ``quota`` of tokens to within one document.  A null source is a source of its own; null texts have one
    token; rows with the same id are drawn one after the other in the order of their block, rows without an id are
    drawn by the MD5 of their text.  Other columns do not matter; an empty table gives no rows.  A source of
    n documents has about sqrt(n) blocks of sqrt(n) documents, so no task ever sorts a whole source.
    """
    rows = staged(_measured(docs, doc_id, text, source))
    taken = _with_copies(rows, rows, budget_share=budget_share, max_repeats=max_repeats, min_entropy=min_entropy, seed=seed)
    return taken.select("doc_id", "source", "n_tokens", "exponent", "quota", "block", "copies")


def apply_mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", budget_share: float = 1.0, max_repeats: float | None = 1.5, min_entropy: float | None = None, seed: int = 17) -> DataFrame:
    """The mixed corpus: rows of ``docs`` with all their columns, each as often as the mix takes it."""
    rows = staged(_measured(docs, doc_id, text, source))
    whole = _measured(docs, doc_id, text, source, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    taken = _with_copies(whole, rows, budget_share=budget_share, max_repeats=max_repeats, min_entropy=min_entropy, seed=seed)
    return taken.where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), "copies"))).select("_row.*")


def mix_sql(table: str, *, max_repeats: float = 1.5, seed: int = 17) -> str:
    """The same for DuckDB, with the budget of all tokens."""
    draw = lambda s: f"('0x' || md5({s})[1:15])::BIGINT"
    return f"""
WITH r AS (SELECT doc_id, source, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS num, greatest(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')), 1)::BIGINT AS n_tokens FROM {table}),
s AS (SELECT source, sum(n_tokens)::BIGINT AS tokens, count(*) AS n_docs FROM r GROUP BY 1),
b AS (SELECT sum(tokens)::BIGINT AS budget FROM s),
g AS (SELECT k, max(pow(tokens::DOUBLE, k / {STEPS}.0::DOUBLE) / tokens) / sum(pow(tokens::DOUBLE, k / {STEPS}.0::DOUBLE)) * any_value(budget) AS top
      FROM s, b, range(0, {STEPS} + 1) x(k) GROUP BY k),
e AS (SELECT coalesce(min(k) FILTER (WHERE top <= {max_repeats}), {STEPS}) AS k FROM g),
z AS (SELECT sum(pow(tokens::DOUBLE, k / {STEPS}.0::DOUBLE)) AS z FROM s, e),
q AS (SELECT source, tokens, k / {STEPS}.0::DOUBLE AS exponent, floor(round(pow(tokens::DOUBLE, k / {STEPS}.0::DOUBLE) / z * budget, 3))::BIGINT AS quota,
      ceil(sqrt(n_docs::DOUBLE))::BIGINT AS n_blocks FROM s, e, z, b),
p AS (SELECT r.*, q.tokens, q.quota, q.exponent, {draw(f"'{seed}|block|' || num")} % n_blocks AS block
      FROM r JOIN q ON r.source IS NOT DISTINCT FROM q.source),
f AS (SELECT source, block, coalesce(sum(t) OVER (PARTITION BY source ORDER BY {draw(f"'{seed}|turn|' || coalesce(source, '') || '|' || block")}, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled
      FROM (SELECT source, block, sum(n_tokens) AS t FROM p GROUP BY 1, 2)),
u AS (SELECT p.*, filled + sum(n_tokens) OVER (PARTITION BY p.source, p.block ORDER BY {draw(f"'{seed}|doc|' || num")}, doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n_tokens AS upto
      FROM p JOIN f ON p.source IS NOT DISTINCT FROM f.source AND p.block = f.block)
SELECT doc_id, source, n_tokens, exponent, quota, block, (quota // tokens + (upto < quota % tokens)::BIGINT)::BIGINT AS copies FROM u"""
