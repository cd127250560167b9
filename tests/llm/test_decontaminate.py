import random
import re

import pytest
from pyspark.sql import functions as F
from llm_cases import odd_rows, words

from driftlog.llm import decontaminate as d

ITEM = "item_id long, text string, key string, size int, s string"


def slow_words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def grams(w, k):
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]


def similarity(a, b):
    shared = sum(min(a.count(x), b.count(x)) for x in set(a))
    return shared / (len(a) + len(b) - shared)


def slow(docs, items):
    found = {}
    for i, text in docs:
        w = slow_words(text)
        for j, item in items:
            t = slow_words(item)
            k = min(5, len(t))
            if not t or len(w) < k:
                continue
            best = None
            for s in range(max(1, len(w) - len(t) + 1)):
                x = similarity(grams(w[s:s + len(t)], k), grams(t, k))
                if x >= 0.8 and (best is None or x > best[0]):
                    best = (x, s)
            if best:
                found.setdefault((i, j), []).append((round(best[0], 9), best[1], len(t)))
    return found


@pytest.fixture(scope="module")
def case():
    rnd = random.Random(8)
    items = [(j, " ".join(words(rnd, n, 300))) for j, n in enumerate((30, 45, 60, 25, 12, 5))]
    items += [(20, "only three words"), (21, "ab"), (22, ""), (23, None), (24, "a a a a a a a a a a"), (25, items[0][1])]
    docs = []
    for i in range(60):
        w = words(rnd, rnd.randrange(5, 150), 300)
        if i % 3 == 0:
            t = items[i % 6][1].split()
            if i % 2:  # edits at an end cost little, in the middle much
                t[rnd.choice([0, -1, len(t) // 2])] = "edited"
            if i % 5 == 0:
                t = t[:-1]
            at = rnd.randrange(len(w) + 1)
            w[at:at] = [x.upper() + "," for x in t]
        docs.append((100 + i, " ".join(w)))
    docs += [(1, items[2][1]), (2, items[2][1]), (3, " ".join(items[2][1].split()[:56])), (4, "Only THREE, words!"), (5, "ab"), (6, None),
             (7, ""), (8, "x ab y"), (9, "a " * 30), (None, items[1][1]), (2, items[2][1])]
    return docs, items


def test_every_window_is_found(spark, case):
    docs, items = case
    benchmark = spark.createDataFrame([(*x, "k", 1, "s") for x in items], ITEM)
    frame = spark.createDataFrame([(*x, "k", 1) for x in docs], "doc_id long, text string, key string, m int").repartition(3)
    got = {}
    for r in d.contaminated(frame, benchmark).collect():
        got.setdefault((r.doc_id, r.item_id), []).append((round(r.similarity, 9), r.start, r.n_words))
    want = slow(docs, items)
    assert got == want and len(want) > 20
    clean = d.without_contaminated(frame, benchmark)
    assert clean.columns == frame.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in docs} - {i for i, _ in want}
    with pytest.raises(ValueError):
        d.contaminated(frame, benchmark, radius=d.RADIUS + 1)


def test_blocks_find_all_fingerprints_within_the_radius(spark):
    """Random fingerprints at every distance up to the radius share a block; beyond it they may not."""
    rnd = random.Random(13)
    rows = []
    for far in [*range(d.RADIUS + 1)] * 3:
        f = rnd.getrandbits(256)
        g = f
        for bit in rnd.sample(range(256), far):
            g ^= 1 << bit
        if far == d.RADIUS:  # the worst case: two bits of every block but one
            g = f
            for k in range(d.BLOCKS):
                for bit in rnd.sample(range(8), 1 if k == 5 else 2):
                    g ^= 1 << (8 * k + bit)
        signed = lambda x: [((x >> 64 * k) & (2**64 - 1)) - (((x >> 64 * k) & (1 << 63)) << 1) for k in range(4)]
        rows.append((far, signed(f), signed(g)))
    df = spark.createDataFrame(rows, "far int, f array<long>, g array<long>")
    met = F.arrays_overlap(d.blocks(F.col("f"), False), d.blocks(F.col("g"), True))
    got = df.select("far", d.distance(F.col("f"), F.col("g")).alias("n"), met.alias("met")).collect()
    assert all(r.far == r.n and r.met for r in got)


def test_simhash_is_the_majority_of_each_bit(spark):
    hashes = [[5, -7, 123456789], [1 << 40], [7, 7, 9, -1, 3, 2]]
    df = spark.createDataFrame([(h,) for h in hashes], "s array<long>")
    seeded = [F.transform("s", (lambda seed: lambda x: F.xxhash64(x, F.lit(seed)))(k)).alias(f"h{k}") for k in range(d.SEEDS)]
    for r in df.select(d.simhash(F.col("s")).alias("fp"), *seeded).collect():
        for k in range(d.SEEDS):
            bits = [2 * sum((x >> b) & 1 for x in r[f"h{k}"]) > len(r[f"h{k}"]) for b in range(64)]
            assert r.fp[k] % 2**64 == sum(1 << b for b, on in enumerate(bits) if on)


def test_beyond_the_broadcast_bound(spark, case, monkeypatch):
    docs, items = case
    benchmark = spark.createDataFrame([(*x, "k", 1, "s") for x in items], ITEM)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted(map(repr, d.contaminated(frame, benchmark).collect()))
    monkeypatch.setattr(d, "BROADCAST_SHINGLES", 0)
    assert sorted(map(repr, d.contaminated(frame, benchmark).collect())) == want


def test_empty_tables(spark, no_docs, odd_docs):
    none = spark.createDataFrame([], ITEM)
    some = spark.createDataFrame([(1, "one two three four five six", "k", 1, "s")], ITEM)
    assert d.contaminated(no_docs, some).count() == 0
    assert d.contaminated(odd_docs, none).count() == 0 and d.contaminated(odd_docs, some).count() == 0
    assert d.without_contaminated(odd_docs, none).count() == len(odd_rows())


def test_default_radius_loses_no_pair(spark):
    """Items with one word replaced in the middle: similarity 0.8 or little more, every one found as it stands."""
    rnd = random.Random(21)
    docs, items = [], []
    for j in range(400):
        w = words(rnd, rnd.choice([49, 50, 55]), 5000)
        items.append((j, " ".join(w)))
        w[len(w) // 2] = "edited"
        docs.append((j, " ".join(words(rnd, 3, 5000) + w)))
    benchmark = spark.createDataFrame([(*x, "k", 1, "s") for x in items], ITEM)
    got = {(r.doc_id, r.item_id): round(r.similarity, 9)
           for r in d.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()}
    want = {}
    for (i, text), (_, item) in zip(docs, items):
        w, t = text.split(), item.split()
        want[i, i] = round(max(similarity(grams(w[s:s + len(t)], 5), grams(t, 5)) for s in range(len(w) - len(t) + 1)), 9)
    assert got == want and min(want.values()) < 0.81
