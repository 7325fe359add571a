"""Benchmark decontamination with DataFrame functions only.

A document window can be as similar to an item as asked only if enough of its word shingles are the item's.  So
item-sized windows are laid at every start from which enough of the item's shingles can be covered, wherever
these lie and in whatever order; windows that the document's edge cuts short are laid where a shared shingle's
offset puts the item over the edge.  A window is verified by the exact weighted shingle similarity against each item
that laid it, which misses nothing.  Besides, each distinct window gets a SimHash over its words and is verified
against the items within ``radius`` too, whichever item laid it: fingerprints are cut into ``radius + 1`` blocks; two
within the radius agree in one block, so an equi-join on (block, value) finds every such pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, words_of


def _shingles(words: Column, width: int | Column) -> Column:
    """Hashes of every ``width``-word shingle, in order; none if there are fewer words."""
    last = F.size(words) - width
    return F.when(last >= 0, F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(words, i, width)))).otherwise(F.array().cast("array<long>"))


def _simhash(words: Column) -> Column:
    """64-bit SimHash of the words, repeats included."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    ones = lambda b: F.aggregate(hashes, F.lit(0), lambda a, h: a + F.getbit(h, b).cast("int"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(F.when(ones(b) * 2 > F.size(words), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))))


def _blocks(fingerprint: str, radius: int) -> Column:
    """``(number, value)`` of each block of bits."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    parts = [F.struct(F.lit(i).alias("n"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("v")) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return F.explode(F.array(*parts))


def _weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of the lesser over sum of the greater weights; a shingle weighs as often as it occurs."""
    count = lambda xs, s: F.size(F.filter(xs, lambda x: x == s))
    common = lambda p: F.aggregate(F.array_intersect(p["a"], p["b"]), F.lit(0), lambda t, s: t + F.least(count(p["a"], s), count(p["b"], s)))
    # both sides, and then the lesser sum, are bound to a name, or they would be made anew for every shingle
    sums = F.transform(F.array(F.struct(a.alias("a"), b.alias("b"))), lambda p: F.struct(common(p).alias("least"), (F.size(p["a"]) + F.size(p["b"])).alias("all")))
    return F.transform(sums, lambda t: F.when(t["all"] > 0, t["least"] / (t["all"] - t["least"])).otherwise(0.0))[0]


def _starts(places: Column, need: Column, room: Column) -> Column:
    """Every start from which ``room`` positions hold at least ``need`` of the sorted ``places``.

    Each place adds the starts at which it is the first one held, so no start comes twice.
    """

    def first_held(i: Column) -> Column:
        after = F.when(i > 1, F.element_at(places, i - 1) + 1)
        low = F.greatest(F.element_at(places, i + need - 1) - room + 1, after)
        high = F.element_at(places, i)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    last = F.size(places) - need + 1
    return F.when(last >= 1, F.flatten(F.transform(F.sequence(F.lit(1), last), first_held))).otherwise(F.array().cast("array<int>"))


def find_leaks(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 5, radius: int = 8, min_similarity: float = 0.8, broadcast_rows: int = 1_000_000) -> DataFrame:
    """Verified passages: ``doc_id, text_hash, start, n_words, item_id, similarity`` (``start`` counts words from 0).

    Texts are lower-cased and cut at ASCII white space.  Items with fewer than ``width`` words are one shingle of
    their own width; items without words match nothing, nor do null texts.  A document is told by its id and
    text hash, so null and repeated ids are safe.  The items' shingles are broadcast only if there are at most
    ``broadcast_rows`` of them (24 bytes each); beyond that both sides are shuffled.
    """
    lower = lambda c: words_of(F.lower(F.col(c)))
    item = staged(items.select(F.col(item_id).alias("item_id"), lower(item_text).alias("iw")).where(F.size("iw") > 0).withColumn("k", F.least(F.size("iw"), F.lit(width))).withColumn("ih", F.xxhash64("iw")))
    marks = staged(item.select("k", F.size("iw").alias("len"), "ih", F.posexplode(_shingles(F.col("iw"), F.col("k"))).alias("off", "h")).distinct())
    n_marks = marks.count()
    marks = F.broadcast(marks) if n_marks <= broadcast_rows else marks
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumn("text_hash", F.xxhash64("_text"))
    hits = None
    for k in sorted(r.k for r in item.select("k").distinct().collect()):  # at most ``width`` values
        places = keyed.withColumn("_w", lower("_text")).select("doc_id", "text_hash", F.size("_w").alias("n"), F.posexplode(_shingles(F.col("_w"), k)).alias("pos", "h"))
        found = places.join(marks.where(F.col("k") == k), "h").select("doc_id", "text_hash", "n", "k", "len", "ih", "pos", (F.col("pos") - F.col("off")).alias("put"))
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = keyed.select("doc_id", "text_hash", *[F.lit(0).alias(c) for c in ("n", "k", "len")], F.lit(0).cast("long").alias("ih"), F.lit(0).alias("pos"), F.lit(0).alias("put")).where("false")
    # a window of similarity t holds at least t of the item's shingles, and t / (1 + t) of both sides' together
    room = F.col("len") - F.col("k") + 1
    held = hits.groupBy("doc_id", "text_hash", "n", "k", "len", "ih").agg(F.sort_array(F.collect_set("pos")).alias("places"), F.collect_set(F.when((F.col("put") < 0) | (F.col("put") + F.col("len") > F.col("n")), F.col("put"))).alias("over"))
    need = F.greatest(F.lit(1), F.ceil(min_similarity * room - 1e-9).cast("int"))
    whole = F.filter(_starts(F.col("places"), need, room), lambda s: (s >= 0) & (s + F.col("len") <= F.col("n")))
    held = staged(held.where(F.size("places") >= need).withColumn("starts", F.concat(whole, "over")))
    stop = lambda s: F.least(s + F.col("len"), F.col("n"))
    inside = lambda s: F.size(F.filter("places", lambda p: (p >= s) & (p + F.col("k") <= stop(s))))
    full = lambda s: inside(s) >= min_similarity / (1 + min_similarity) * (room + stop(s) - F.greatest(s, F.lit(0)) - F.col("k") + 1) - 1e-9
    spots = held.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "ih", F.transform(F.filter("starts", full), lambda s: F.struct(F.greatest(s, F.lit(0)).alias("start"), stop(s).alias("stop"))).alias("spots"))
    cut = F.flatten(F.transform(F.array(lower("_text")), lambda w: F.transform("spots", lambda s: F.struct(s["start"].alias("start"), F.slice(w, s["start"] + 1, s["stop"] - s["start"]).alias("w")))))
    laid = keyed.join(spots.where(F.size("spots") > 0), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h"))).select("doc_id", "text_hash", "ih", F.explode(cut).alias("s")).select("doc_id", "text_hash", "ih", "s.start", "s.w")
    laid = staged(laid.withColumn("wh", F.xxhash64("w")))
    windows = staged(laid.groupBy("wh").agg(F.first("w").alias("w")).withColumn("fp", _simhash(F.col("w"))))
    item = staged(item.withColumn("ifp", _simhash(F.col("iw"))))
    left = windows.select("fp").distinct().select("fp", _blocks("fp", radius).alias("b")).select("fp", "b.*")
    right = item.select("ifp").distinct().select("ifp", _blocks("ifp", radius).alias("b")).select("ifp", "b.*")
    near = left.join(right, ["n", "v"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= radius).select("fp", "ifp").distinct()
    pairs = laid.select("wh", "ih").union(windows.join(near, "fp").join(item.select("ifp", "ih"), "ifp").select("wh", "ih")).distinct()
    similarity = _weighted_similarity(_shingles(F.col("w"), F.col("k")), _shingles(F.col("iw"), F.col("k")))
    sides = pairs.join(windows.select("wh", "w"), "wh").join(item.dropDuplicates(["ih"]).select("ih", "iw", "k"), "ih")
    alike = sides.select("wh", "ih", similarity.alias("similarity")).where(F.col("similarity") >= min_similarity)
    verified = staged(alike.join(item.select("ih", "item_id").distinct(), "ih").select("wh", "item_id", "similarity"))
    return laid.select("doc_id", "text_hash", "start", F.size("w").alias("n_words"), "wh").distinct().join(verified, "wh").drop("wh")


def leaky_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per contaminated document: ``doc_id, text_hash, contaminated`` (true), ``n_items``, the least matching
    ``item_id`` and the top ``similarity``.  Clean documents are absent."""
    leaks = find_leaks(docs, items, **options)
    each = leaks.groupBy("doc_id", "text_hash").agg(F.countDistinct("item_id").alias("n_items"), F.min("item_id").alias("item_id"), F.round(F.max("similarity"), 6).alias("similarity"))
    return each.select("doc_id", "text_hash", F.lit(True).alias("contaminated"), "n_items", "item_id", "similarity")


def mark_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Every document, clean ones too, with the columns of ``leaky_documents`` but the text hash."""
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    each = leaky_documents(docs, items, **options).withColumnRenamed("doc_id", "_d").withColumnRenamed("text_hash", "_h")
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"))
    joined = keyed.join(each, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")), "left")
    return joined.select("doc_id", F.coalesce("contaminated", F.lit(False)).alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "item_id", "similarity")


def drop_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without a verified passage, with all their columns, whatever these are called.

    Null and empty texts hold no passage and stay; repeated rows stay or go together.
    """
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    bad = find_leaks(docs, items, **options).select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    whole = docs.select(F.col(doc_id).cast("long").alias("own_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("own_hash"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return whole.join(bad, F.col("own_id").eqNullSafe(F.col("bad_id")) & (F.col("own_hash") == F.col("bad_hash")), "left_anti").select("row.*")
