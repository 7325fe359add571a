import itertools
import random
import re
from collections import Counter

import numpy as np
import xxhash

from geolist.llm import simhash as s
from geolist.llm.common import components


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t))


def plain_print(t, width=3):
    w = words(t)
    parts = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def groups(n, linked):
    root = list(range(n))
    for _ in range(n):
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
        root = [root[r] for r in root]
    return root


def test_every_pair_within_the_radius_shares_a_table():
    rng = random.Random(0)
    for radius in (1, 2, 3):
        masks = s.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for bits in itertools.chain(itertools.combinations(range(64), 2), (rng.sample(range(64), radius) for _ in range(2000))):
            if len(bits) <= radius:
                assert any(not any(m >> b & 1 for b in bits) for m in masks)


def test_components_against_brute_force(docs, doc_rows):
    got = s.simhash_components(docs.selectExpr("*", "'x' as fp", "1 as root")).collect()
    fps = [plain_print(r[1]) for r in doc_rows]
    root = groups(len(fps), [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3])
    least = {}
    for r, x in zip(root, doc_rows):
        if x[0] is not None:
            least[r] = min(least.get(r, x[0]), x[0])
    want = [(x[0], f"{fp:016x}", least.get(r)) for x, fp, r in zip(doc_rows, fps, root)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_links_of_a_crowded_bucket(spark):
    rng = random.Random(4)
    points = {rng.getrandbits(64) for _ in range(200)}
    for base in list(points)[:3]:
        for _ in range(150):
            x = base
            for b in rng.sample(range(64), 3):
                x ^= 1 << b
            points.add(x)
    values = sorted(points)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v, v, 0) for v in signed], "id long, fp long, check long")
    label = {r.node: r.root for r in components(s.link_edges(df, 3)).collect()}
    want = groups(len(values), [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 3])
    assert len({label.get(v, v) for v in signed}) == len(set(want))
    for a, b in itertools.pairwise(range(len(values))):
        assert (want[a] == want[b]) == (label.get(signed[a], signed[a]) == label.get(signed[b], signed[b]))


def jaccard(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (words(a), words(b)))
    return len(x & y) / len(x | y) if x and y else float((a or "") == (b or ""))


def test_near_duplicates_keep_one_of_each_group(spark, docs, doc_rows):
    rows = list(doc_rows)
    rng = random.Random(8)
    base = [f"t{rng.randrange(900)}" for _ in range(200)]
    for k in range(40):
        near = list(base)
        for _ in range(4):
            near[rng.randrange(200)] = f"n{k}"
        rows.append((2000 + k, " ".join(near), "en", "src0", None))
    frame = spark.createDataFrame(rows, docs.schema)
    texts = sorted({r[1] or "" for r in rows})
    root = groups(len(texts), [(a, b) for a in range(len(texts)) for b in range(a) if jaccard(texts[a], texts[b]) >= 0.8])
    least = {}
    for r in rows:
        g = root[texts.index(r[1] or "")]
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    for chunk in (512, 4):
        got = s.drop_near_duplicates(frame, chunk=chunk)
        assert got.columns == frame.columns
        kept = Counter(r.doc_id for r in got.collect())
        assert kept == Counter([*least.values(), *[None] * (len(set(root)) - len(least))])


def test_large_groups_that_hang_on_one_original_or_on_a_chain(spark):
    rng = random.Random(12)
    texts = []
    for k in range(2):
        base = [f"b{k}_{i}" for i in range(70)]
        texts.append(" ".join(base))
        for c in range(25):  # each near the original, not near each other
            copy = list(base)
            copy[rng.randrange(5, 65)] = f"c{k}_{c}"
            texts.append(" ".join(copy))
    chain = [f"k{i}" for i in range(80)]
    for step in range(30):  # each near the next only
        chain[step * 2 : step * 2 + 1] = [f"s{step}"]
        texts.append(" ".join(chain))
    texts += [" ".join(f"z{k}_{i}" for i in range(50)) for k in range(3)]
    root = groups(len(texts), [(a, b) for a in range(len(texts)) for b in range(a) if jaccard(texts[a], texts[b]) >= 0.8])
    rows = [(i, t, "a", 1, 2, 3) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string, _k string, _i long, _l long, text_key long")
    for chunk in (3,):
        got = s.drop_near_duplicates(frame, chunk=chunk)
        assert got.columns == frame.columns
        assert {r.doc_id for r in got.collect()} == set(root)


def test_texts_that_differ_in_one_piece(spark):
    rng = random.Random(9)
    texts = []
    for k in range(60):
        base = [f"v{rng.randrange(5000)}" for _ in range(rng.randint(60, 400))]
        part = [f"v{rng.randrange(5000)}" for _ in range(int(len(base) * rng.choice((0.1, 0.13, 0.16, 0.19))))]
        at = rng.randrange(len(base) - len(part))
        half = len(part) // 2
        texts += [" ".join(base), " ".join((base + part, base[: len(base) - len(part)], base[:at] + part[:half] + base[at + half :])[k % 3])]
    root = groups(len(texts), [(a, b) for a in range(len(texts)) for b in range(a) if jaccard(texts[a], texts[b]) >= 0.8])
    assert 60 <= len(set(root)) < 70
    assert sum(0.8 <= jaccard(*texts[k : k + 2]) <= 0.9 for k in range(0, 120, 2)) > 30
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in s.drop_near_duplicates(frame).collect()} == set(root)


def test_prefixes_and_parities_lose_no_pair():
    rng = np.random.default_rng(5)
    for _ in range(2000):
        union = rng.integers(0, 1 << 63, int(rng.integers(1, 60))).astype(np.uint64)
        side = rng.choice(3, len(union), p=(0.8, 0.1, 0.1))
        x, y = np.unique(union[side != 1]), np.unique(union[side != 2])
        if not len(x) or not len(y) or len(np.intersect1d(x, y)) < 0.8 * len(np.union1d(x, y)):
            continue
        common = np.unique(union[rng.random(len(union)) < 0.5])
        often = rng.integers(3, 9, len(common))
        assert len(np.intersect1d(*(s._prefix(v, common, often, 0.8) for v in (x, y))))
        assert s._may_reach(0.8, np.array([len(x)]), np.array([len(y)]), np.bitwise_count(s._parity(x, 256) ^ s._parity(y, 256)).sum(keepdims=True)).all()


def test_components_of_a_long_chain(spark):
    ids = list(range(1000))
    random.Random(1).shuffle(ids)
    chain = spark.createDataFrame([*itertools.pairwise(ids), (2001, 2000)], "a long, b long")
    assert {r.node: r.root for r in components(chain).collect()} == dict.fromkeys(ids, 0) | {2000: 2000, 2001: 2000}


def test_empty_table(no_docs):
    assert s.simhash_components(no_docs).count() == 0
    assert s.drop_near_duplicates(no_docs).count() == 0


def test_sketches_fold_and_tell_long_texts_apart():
    rng = np.random.default_rng(8)
    for n in (50, 3000, 12_000):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = np.r_[a[n // 10 :], rng.integers(0, 2**63, n // 10).astype(np.uint64)]
        far = rng.integers(0, 2**63, n).astype(np.uint64)
        bits = s._sketch_bits(n)
        assert (s._folded(s._parity(a, 4 * bits)[None], bits // 64)[0] == s._parity(a, bits)).all()
        differ = lambda x, y: np.bitwise_count(s._parity(x, bits) ^ s._parity(y, bits)).sum()
        both = lambda x, y: bool(s._may_reach(0.8, np.array([n]), np.array([n]), np.array([differ(x, y)]))[0])
        assert both(a, b) and not both(a, far)


def test_what_similar_sets_share_outlives_the_spare_part():
    rng = np.random.default_rng(6)
    met = 0
    for _ in range(3000):
        union = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 80))).astype(np.uint64))
        side = rng.choice(3, len(union), p=(0.84, *rng.permutation((0.13, 0.03))))
        x, y = union[side != 1], union[side != 2]
        if not len(x) or not len(y) or len(np.intersect1d(x, y)) < 0.8 * len(union):
            continue
        met += 1
        common = union[rng.random(len(union)) < 0.5]
        often = rng.integers(3, 9, len(common))
        prefixes = [s._prefix(v, common, often, 0.8) for v in (x, y)]
        count = dict(zip(union.tolist(), rng.integers(0, 4, len(union)).tolist()))  # none: met under one label
        count |= {h: max(1, count[h]) for h in np.intersect1d(*prefixes).tolist()}
        flat, owner = np.concatenate(prefixes), np.repeat([0, 1], [len(p) for p in prefixes])
        keep = s._rarest_shared(np.array([count[h] for h in flat.tolist()]), flat, owner, s._spare(np.array([len(x), len(y)]), 0.8))
        assert len(np.intersect1d(flat[keep & (owner == 0)], flat[keep & (owner == 1)]))
    assert met > 1000


def test_long_texts_that_share_passages_meet_in_no_group(spark, monkeypatch):
    rng = random.Random(14)
    word = lambda: f"v{rng.randrange(10**9)}"
    passages = 2 * [[word() for _ in range(30)] for _ in range(360)]  # each in two texts, too few to count as frequent
    rng.shuffle(passages)
    texts = [" ".join(w for p in passages[8 * k : 8 * k + 8] for w in [*p, *(word() for _ in range(150))]) for k in range(90)]
    near = texts[0].split()
    near[500:600] = [word() for _ in range(100)]  # one block replaced: no SimHash is near
    texts.append(" ".join(near))
    assert 0.8 <= jaccard(texts[0], texts[-1]) < 0.9
    seen, linked = [], s._linked_texts
    monkeypatch.setattr(s, "_linked_texts", lambda rows, members, **how: seen.append(members.count()) or linked(rows, members, **how))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in s.drop_near_duplicates(frame).collect()) == list(range(90))
    assert seen == [2]  # before, all 91 texts were one candidate group


def test_shared_prefixes_of_packed_and_plain_lists(spark):
    rng = np.random.default_rng(3)
    pool = np.unique(rng.integers(1, 1 << 39, 300)) << 24  # nothing is lost by packing
    # one label has half the texts and is spread over blocks, the others are in one block each
    rows = [(i, 7 if i % 2 else 100 + i % 60, 20, [0], [int(x) for x in rng.choice(pool, 6, replace=False)]) for i in range(240)]
    rows += [(1000 + i, 7, 20, [0], [-(i % 5 + 1) << 24]) for i in range(40)]  # under one label only, in many blocks
    under = {}
    for _, label, _, _, prefix in rows:
        for h in prefix:
            under.setdefault(h, set()).add(label)
    want = Counter((label, h) for _, label, _, _, prefix in rows for h in prefix if len(under[h]) > 1)
    assert 500 < want.total() < 240 * 6 + 1
    plain = spark.createDataFrame(rows, "id long, label long, size long, parity array<long>, prefix array<long>")
    blobs = [(*r[:4], s._packed(np.array(r[4], np.int64).view(np.uint64))) for r in rows]
    packed = spark.createDataFrame(blobs, "id long, label long, size long, parity array<long>, prefix binary")
    for frame in (plain, packed):
        got = s._shared_prefixes(frame, block_hashes=100).collect()
        assert Counter((r.label, h) for r in got for h in r.prefix) == want
