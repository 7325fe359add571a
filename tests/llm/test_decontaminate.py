import random
import re
from collections import Counter

from geolist.llm import decontaminate as d

ITEMS = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item"), (3, None), (4, ""), (5, "one two three four five six seven eight nine ten one two three four five six seven"), (5, "one two three four five six seven eight nine ten one two three four five six seven")]


def words(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").lower()) if w]


def similarity(a, b, k):
    x, y = (Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) for w in (a, b))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def brute(rows, items, width=5, floor=0.8):
    out = set()
    for i, text in rows:
        w = words(text)
        for item, t in items:
            v = words(t)
            k = min(width, len(v))
            for s in range(-len(v), len(w)) if v else ():
                aligned = any(w[s + o : s + o + k] == v[o : o + k] for o in range(max(0, -s), len(v) - k + 1))
                if aligned and similarity(w[max(0, s) : s + len(v)], v, k) >= floor:
                    out.add((i, item))
    return out


def test_against_brute_force(spark):
    item = ITEMS[0][1].split()
    five = ITEMS[4][1]
    rows = [
        (1, "x y z " + " ".join(item).upper() + " tail words"), (2, " ".join(item[:11]) + " other"), (3, " ".join(item[:6])), (4, "a Short\titem b"), (5, None), (6, ""),
        (7, five), (8, "pre " + five.replace("ten", "TEN") + "!!! post"), (9, " ".join(item[1:])), (None, "null " + " ".join(item)), (1, "another row with the same id"), (1, "another row with the same id"),
        (10, ("filler " * 3000) + " ".join(item) + (" filler" * 3000)), (11, five + " " + five),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'e' as fp", "1 as item_id", "2 as start")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for limit in (1_000_000, 0):  # broadcast and shuffled shingles
        leaks = d.find_leaks(docs, items, broadcast_rows=limit, radius=20)
        assert {(r.doc_id, r.item_id) for r in leaks.collect()} == brute(rows, ITEMS)
    marks = d.mark_leaks(docs, items, radius=20)
    assert marks.count() == len(rows)
    assert marks.where("doc_id = 1 and contaminated").count() == 1
    assert d.drop_leaks(docs, items, radius=20).columns == docs.columns
    assert d.drop_leaks(docs, items, radius=20).count() == len(rows) - marks.where("contaminated").count()


def brute_all_starts(rows, items, width=5, floor=0.8):
    out = set()
    for i, text in rows:
        w = words(text)
        for item, t in items:
            v = words(t)
            k = min(width, len(v))
            for s in range(1 - len(v), len(w)) if v else ():
                whole = 0 <= s <= len(w) - len(v)
                aligned = any(w[s + o : s + o + k] == v[o : o + k] for o in range(max(0, -s), len(v) - k + 1))
                if (whole or aligned) and similarity(w[max(0, s) : s + len(v)], v, k) >= floor:
                    out.add((i, item))
    return out


def test_default_radius_against_all_starts(spark):
    rng = random.Random(6)
    fresh = lambda n: [f"x{rng.randrange(10**6)}" for _ in range(n)]
    items = [(1, fresh(50)), (2, fresh(60)), (3, fresh(40)), (4, ["a", "b"] * 15), (5, fresh(5)), (6, fresh(20))]
    rows = []
    for n, (_, v) in enumerate(items):
        half = len(v) // 2
        rows.append((100 + n, fresh(30) + v[half:] + v[:half] + fresh(30)))
        for part in (0.9, 0.86, 0.8, 0.5):
            keep = int(len(v) * part)
            rows += [(200 + 10 * n + int(10 * part), fresh(40) + v[:keep] + fresh(40)), (300 + n, v[-keep:]), (400 + n, fresh(9) + v[:keep]), (500 + n, v[:keep] + fresh(9))]
    rows, items = [(i, " ".join(w)) for i, w in rows], [(i, " ".join(v)) for i, v in items]
    leaks = d.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = brute_all_starts(rows, items)
    assert {(r.doc_id, r.item_id) for r in leaks.collect()} == want and {(100, 1), (209, 1), (209 + 10, 2)} <= want


def test_blocks_find_every_pair_within_the_radius(spark):
    import random

    rng = random.Random(3)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 8):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    left = df.select("a", d._blocks("a", 8).alias("x")).select("a", "x.*")
    right = df.select("b", d._blocks("b", 8).alias("x")).select("b", "x.*")
    found = {tuple(r) for r in left.join(right, ["n", "v"]).select("a", "b").distinct().collect()}
    assert set(pairs) <= found


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, ITEMS[0][1], *"abcdefg"), (2, "clean", *"abcdefg"), (None, None, *"abcdefg")], "doc_id long, text string, _d string, _h string, _w string, own_id string, bad_id string, row string, text_hash string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    left = d.drop_leaks(docs, items)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {2, None}
    assert d.mark_leaks(docs, items).where("contaminated").count() == 1


def test_empty_tables(spark, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert d.mark_leaks(no_docs, items).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert [r.contaminated for r in d.mark_leaks(docs, none).collect()] == [False]
