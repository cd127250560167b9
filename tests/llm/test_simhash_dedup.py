import random

from llm_cases import odd_rows, union_find
from xxhash import xxh64_intdigest

from driftlog.llm.components import connected_components
from driftlog.llm.simhash_dedup import keep_one, near_pairs, simhash_groups


def slow_fingerprint(text):
    w = (text or "").encode().lower().split()
    rows = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else ([b" ".join(w)] if w else [])
    h = [xxh64_intdigest(x, 42) for x in rows]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_groups_match_brute_force(spark, odd_docs):
    rows = odd_rows()
    prints = [slow_fingerprint(r[1]) for r in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 3]
    root = union_find(len(rows), links)
    ids = {}
    for r, x in zip(rows, root):
        ids.setdefault(x, []).append(r[0])
    want = sorted(((r[0], p, min((i for i in ids[x] if i is not None), default=None)) for r, p, x in zip(rows, prints, root)), key=repr)
    got = sorted(((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in simhash_groups(odd_docs).collect()), key=repr)
    assert got == want


def test_keep_one_keeps_columns_and_one_of_each(odd_docs):
    got = keep_one(odd_docs)
    assert got.columns == odd_docs.columns
    ids = [r.doc_id for r in got.collect()]
    assert 1 in ids and 2 not in ids and 4 in ids and 5 not in ids and 7 in ids


def test_pairs_within_the_radius_are_all_found(spark):
    rnd = random.Random(2)
    prints = set()
    for _ in range(40):
        x = rnd.getrandbits(64)
        prints.add(x)
        for _ in range(4):
            prints.add(x ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 6))))
    signed = [(x - 2 ** 64 if x >> 63 else x,) for x in prints]
    for segments in (1, 2, 3, 4):
        if segments == 1:
            continue  # a ball of radius 3 over 64 bits: right, but slow
        got = {tuple(r) for r in near_pairs(spark.createDataFrame(signed, "fp long"), 3, segments).collect()}
        want = {(a[0], b[0]) for a in signed for b in signed
                if a < b and bin((a[0] ^ b[0]) % 2 ** 64).count("1") <= 3}
        assert got == want and want


def test_empty_table(no_docs):
    assert simhash_groups(no_docs).count() == 0 and keep_one(no_docs).columns == no_docs.columns


def test_components_match_union_find(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 260)] + [(500, 500 + i) for i in range(1, 200)]
    edges += [(rnd.randrange(1000, 1400), rnd.randrange(1000, 1400)) for _ in range(250)]
    df = spark.createDataFrame(edges + edges[:9] + [(None, 3), (7, 7)], "a long, b long")
    root = union_find(1400, edges)
    want = {x: root[x] for e in edges for x in e if e[0] != e[1]}
    rows = connected_components(df).collect()
    assert len(rows) == len(want) and {r.node: r.component for r in rows} == want
    assert connected_components(df.limit(0)).count() == 0
