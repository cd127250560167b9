import math
import random
import zlib
from collections import Counter

import numpy as np
from llm_cases import odd_rows

from driftlog.llm import pitman_yor as p


def slow_base(rows):
    tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for (_, ws), h in zip(tokens, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
            for (i, ws), h in zip(tokens, held)]


def test_counts_and_base_scores(odd_docs, no_docs):
    got = p.pitman_yor_scores(odd_docs, block_bytes=10_000).collect()
    want = slow_base([(r[0], r[1]) for r in odd_rows()])
    found = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert p.pitman_yor_scores(no_docs).count() == 0


def corpus():
    rnd = random.Random(12)
    follow = {f"a{k}": [f"a{rnd.randrange(40)}" for _ in range(4)] for k in range(40)}
    rows = []
    for i in range(400):
        w = ["a0"]
        while len(w) < 60:
            w.append(rnd.choice(follow[w[-1]]) if rnd.random() < 0.9 else f"a{rnd.randrange(40)}")
        rows.append((i, " ".join(w)))
    return rows


def test_held_out_perplexity_beats_the_base_model(spark):
    got = p.pitman_yor_scores(spark.createDataFrame(corpus(), "doc_id long, text string").repartition(3), block_bytes=20_000).collect()
    held = [r for r in got if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    model, base = (10 ** (-sum(getattr(r, c) for r in held) / tokens) for c in ("score", "base_score"))
    assert len(held) > 30 and model < 0.5 * base


def test_probabilities_add_up_to_one():
    """Over all known words and one unknown word: in the parent and in every context."""
    rnd = np.random.default_rng(1)
    word = np.repeat(np.arange(30), 5)
    context = np.tile(np.arange(5), 30)
    count = rnd.integers(1, 200, len(word))
    tables, customers, parent = p.sample_cells(word, context, count, np.ones(30, np.int64), np.bincount(context, count).astype(np.int64), 30, 1, 3)
    assert (tables >= 1).all() and (tables <= count).all() and np.allclose(customers, np.bincount(word, tables))
    base = (p.PARENT_STRENGTH + p.PARENT_DISCOUNT * parent.sum()) / 31
    below = (customers - p.PARENT_DISCOUNT * parent + base) / (p.PARENT_STRENGTH + customers.sum())
    assert abs(below.sum() + base / (p.PARENT_STRENGTH + customers.sum()) - 1) < 1e-9
    for u in range(5):
        here = context == u
        c = count[here].sum()
        back = (p.STRENGTH + p.DISCOUNT * tables[here].sum()) / (p.STRENGTH + c)
        assert abs(((count - p.DISCOUNT * tables)[here] / (p.STRENGTH + c)).sum() + back - 1) < 1e-9


def test_seating_keeps_customers():
    rng = np.random.default_rng(2)
    customers = np.array([1, 2, 3, 50, 5000])
    alpha = np.array([0.01, 1.0, 100.0, 2.0, 5.0])
    s = p.Seating(customers, alpha, rng)
    for _ in range(60):
        assert (np.bincount(s.cell, s.size) == customers).all() and (s.size > 0).all() and (np.diff(s.cell) >= 0).all()
        s.move(alpha, 0.8)


def test_gibbs_finds_the_number_of_tables():
    """Two customers sit apart with probability alpha / (alpha + 1 - discount)."""
    rng = np.random.default_rng(3)
    n, a, d = 20_000, 0.7, 0.5
    s = p.Seating(np.full(n, 2), np.full(n, 1e-9), rng)
    for _ in range(30):
        s.move(np.full(n, a), d)
    assert abs((s.tables() == 2).mean() - a / (a + 1 - d)) < 0.02


def test_a_word_dealt_over_several_buckets(spark, monkeypatch):
    """Frequent words split by context: the counts stay exact and the scores close to those of one bucket."""
    from driftlog.llm import blocks
    frame = spark.createDataFrame(corpus(), "doc_id long, text string").repartition(2)
    one = {r.doc_id: r for r in p.pitman_yor_scores(frame).collect()}
    monkeypatch.setattr(p, "BUCKET_KEYS", 100)
    monkeypatch.setattr(p, "bucket_count", lambda keys: blocks.bucket_count(keys, 2000))
    many = {r.doc_id: r for r in p.pitman_yor_scores(frame).collect()}
    assert {i: (r.n_known, round(r.base_score, 6)) for i, r in one.items()} == {i: (r.n_known, round(r.base_score, 6)) for i, r in many.items()}
    assert abs(sum(r.score for r in one.values()) / sum(r.score for r in many.values()) - 1) < 0.05


def test_all_customers_are_seated_anew():
    """The number of tables is that to which single moves settle, and the exact one of few and many customers."""
    rng = np.random.default_rng(4)
    n, a, d = 3000, 2.0, p.DISCOUNT
    slow = p.Seating(np.full(n, 12), np.full(n, a), rng)
    for _ in range(12 * 60):
        slow.move(np.full(n, a), d)
    assert abs(p.draw_tables(np.full(n, 12), np.full(n, a), d, rng).mean() / slow.tables().mean() - 1) < 0.04
    for customers, alpha in ((2, 0.7), (200, 0.3), (200, 50.0), (2000, 0.3), (2000, 50.0), (2000, 5000.0)):
        weight = p.log_stirling(d, customers)[customers] + math.log(alpha) * np.arange(1, customers + 1)
        weight = np.exp(weight - weight.max())
        want = (weight * np.arange(1, customers + 1)).sum() / weight.sum()
        got = p.draw_tables(np.full(4000, customers), np.full(4000, alpha), d, rng)
        assert (got >= 1).all() and (got <= customers).all() and abs(got.mean() / want - 1) < 0.03


def test_more_sweeps_leave_the_tables(monkeypatch):
    rnd = np.random.default_rng(5)
    word, context = np.repeat(np.arange(60), 10), np.tile(np.arange(10), 60)
    count = np.where(rnd.random(len(word)) < 0.5, 200, 2000)
    corpus = np.bincount(context, count).astype(np.int64)
    burn_in = p.BURN_IN
    for n in (200, 2000):
        means = []
        for sweeps in (burn_in, 300):
            monkeypatch.setattr(p, "BURN_IN", sweeps)
            runs = [p.sample_cells(word, context, count, np.ones(60, np.int64), corpus, 60, 1, seed)[0][count == n].mean() for seed in range(4)]
            means.append(np.mean(runs))
        assert abs(means[0] / means[1] - 1) < 0.1, (n, means)
