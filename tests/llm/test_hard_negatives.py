"""Hard negatives: lookup tables and whole results against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftlog.llm.hard_negatives import _Best, bit_planes, hard_negatives, scores, subset_tables

SCHEMA = "vec_id long, embedding array<float>, label int, score string, block int"


def slow(rows, is_anchor, positives=5, negatives=10):
    """Plain Python over exact integers."""
    ok = [(i, l, [int(np.floor(256 * float(x))) for x in v]) for i, v, l, *_ in rows
          if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    anchors = {}
    for i, l, v in ok:
        if is_anchor(i):
            anchors[i] = min(anchors.get(i, (l, v)), (l, v))
    out = []
    for a, (label, v) in anchors.items():
        scored = [(-sum(x * y for x, y in zip(v, w)), i, l) for i, l, w in ok]
        scored.sort()
        for s, p, _ in [x for x in scored if x[2] == label and x[1] != a][:positives]:
            fits = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s]
            out += [(a, p, k, x[1], -s, -x[0]) for k, x in enumerate(fits[:negatives], 1)]
    return sorted(out)


def run(spark, rows, parts=3, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(map(tuple, hard_negatives(df, F.col("vec_id") % 10 == 0, **options).collect()))


@pytest.mark.parametrize("width", [1, 8, 13, 64])
@pytest.mark.parametrize("largest", [0, 1, 130, 1 << 20])
def test_lookups_are_inner_products(width, largest):
    rnd = np.random.default_rng(width)
    x, a = (rnd.integers(-largest - 1, largest + 1, (n, width)) for n in (40, 7))
    assert (scores(subset_tables(a, np.int64), bit_planes(x)) == x @ a.T).all()


def test_best_keeps_the_first_by_score_and_id():
    rnd = random.Random(4)
    best, given = _Best(3, 4), []
    for _ in range(20):
        some = [(rnd.randrange(3), rnd.randrange(6), rnd.randrange(50)) for _ in range(15)]
        given += some
        best.offer(*(np.array(c) for c in zip(*some)))
    held = list(zip(*best.rows()))
    for slot in range(3):
        want = sorted(((-s, i) for k, s, i in given if k == slot))[:4]
        assert [(-s, i) for k, s, i in held if k == slot] == want


def rows_of(n, labels=4, width=16, seed=2):
    rnd = random.Random(seed)
    return [(i, [round(rnd.uniform(-0.5, 0.5), 2) for _ in range(width)], rnd.randrange(labels), "s", 1) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"anchors_in_block": 2, "block_rows": 7, "group_rows": 20}])
def test_brute_force(spark, options):
    rows = rows_of(150)
    assert run(spark, rows, **options) == slow(rows, lambda i: i % 10 == 0)


def test_ties_repeats_and_a_hot_label(spark):
    """Equal vectors tie by id; one label holds most rows; repeated rows of other ids are candidates each."""
    same = [0.25] * 8
    rows = [(i, same if i % 3 else [0.125] * 8, 0 if i % 4 else 1, None, None) for i in range(90)]
    rows += [rows[7], rows[7], rows[8]]
    assert run(spark, rows, block_rows=11, group_rows=30) == slow(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = rows_of(60) + [(None, [0.1] * 16, 1, "x", 1), (100, None, 1, "x", 1), (110, [0.1] * 15 + [nan], 1, "x", 1),
                          (120, [inf] + [0.1] * 15, 1, "x", 1), (130, [None] + [0.1] * 15, 1, "x", 1), (140, [0.1] * 16, None, "x", 1),
                          (150, [], 1, "x", 1), (160, [0.5] * 5, 2, "x", 1), (20, rows_of(60)[20][1], rows_of(60)[20][2], "again", 2)]
    assert run(spark, rows) == slow(rows, lambda i: i % 10 == 0)
    assert run(spark, []) == [] and run(spark, [(1, [0.5], 1, "no anchor", 1)]) == []
    assert run(spark, [(10, [0.5], 1, "alone", 1)]) == []
    # a component whose scores could pass 64 bits takes no part
    assert run(spark, rows + [(170, [1e30] * 16, 1, "x", 1)]) == slow(rows, lambda i: i % 10 == 0)
