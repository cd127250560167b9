"""As-of and interval joins, sessions, windows, sketches, cubes and top lists against plain Python and by their plans."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cases import SF_SMALL
from driftlog.functions.clock import DAY, HOUR, bin_of, micros
from driftlog.operators import asof, cubes, intervals, metrics, sessions, sketches, topk, windows
from driftlog.plans import catalog, derived
from test_plans import plan_text

START = datetime(2024, 3, 1)


def test_micros_of_every_kind_of_time(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 03:04:05.678901' AS a, timestamp'1969-12-31 23:59:59.5+00:00' AS b, 7L AS c, "
                   "timestamp_ntz'1969-12-31 23:59:59.5' AS d")
    kinds = dict((f.name, f.dataType) for f in df.schema)
    got = df.select(*[micros(F.col(c), k).alias(c) for c, k in kinds.items()]).first()
    assert tuple(got) == (1704078245678901, -500000, 7, -500000)
    bins = spark.range(1).select(*[bin_of(F.lit(x).cast("long"), 10).alias(f"x{i}") for i, x in enumerate((-11, -10, -1, 0, 9, 10))]).first()
    assert tuple(bins) == (-2, -1, -1, 0, 0, 1)
    with pytest.raises(TypeError):
        micros(F.lit("x"), spark.sql("SELECT 'x' AS x").schema["x"].dataType)


# --- as-of join ------------------------------------------------------------------


def slow_asof(facts, versions):
    out = []
    for seq, k, t in facts:
        ok = [(vt, o, v) for vk, vt, o, v in versions if None not in (vk, vt, k, t) and vk == k and vt <= t]
        out.append((seq, max(ok)[2] if ok else None))
    return sorted(out)


@pytest.mark.parametrize("width", [1, 7, 50, 10_000])
def test_asof_join_matches_brute_force(spark, width):
    rnd = random.Random(width)
    facts = [(i, rnd.choice(["a", "b", "hot", "hot", "none", None]), rnd.choice([rnd.randrange(-50, 400), None, 100])) for i in range(300)]
    versions = [(rnd.choice(["a", "b", "hot", None]), rnd.choice([rnd.randrange(-20, 300), None]), rnd.randrange(3), f"v{i}") for i in range(60)]
    left = spark.createDataFrame(facts, "seq long, k string, t long").repartition(3)
    right = spark.createDataFrame(versions, "k string, vt long, o int, v string").repartition(2)
    got = asof.asof_join(left, right, ("k",), "t", "vt", ("v",), tie=("o",), width=width)
    assert got.columns == ["seq", "k", "t", "v"]
    assert sorted((r.seq, r.v) for r in got.collect()) == slow_asof(facts, versions)


def test_asof_join_of_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", 5)], "seq long, k string, t long")
    right = spark.createDataFrame([("a", 1, "x")], "k string, vt long, v string")
    join = lambda a, b: asof.asof_join(a, b, ("k",), "t", "vt", ("v",)).collect()
    assert join(left.where("false"), right) == [] and [tuple(r) for r in join(left, right.where("false"))] == [(1, "a", 5, None)]
    with pytest.raises(ValueError):
        asof.asof_join(left, left, ("k",), "t", "t", ("seq",))


def test_asof_facts_are_not_windowed(spark):
    """The only window runs over the bins of the versions; with a small dictionary the facts aren't shuffled."""
    text = plan_text(catalog.q_event_name_asof(spark, SF_SMALL))
    assert "BroadcastHashJoin LeftOuter" in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert "event_id" in text and "Sort [ts" not in text


# --- interval join -----------------------------------------------------------------


@pytest.mark.parametrize("lower, upper", [(0, 30), (-20, 10), (5, 5), (-7, -3)])
@pytest.mark.parametrize("hot_rows", [1 << 18, 4])
def test_interval_join_matches_brute_force(spark, lower, upper, hot_rows):
    rnd = random.Random(upper)
    row = lambda i: (i, rnd.choice(["u1", "u2", "hot", "hot", "hot", None]), rnd.choice([None, rnd.randrange(-40, 200)]))
    a, b = [row(i) for i in range(120)], [row(i) for i in range(100)]
    b += b[:5]
    left = spark.createDataFrame(a, "a long, u string, at long").repartition(3)
    right = spark.createDataFrame(b, "b long, u string, bt long").repartition(2)
    got = intervals.interval_join(left, right, ("u",), "at", "bt", lower, upper, hot_rows=hot_rows)
    want = sorted((u, i, t, j, s, s - t) for i, u, t in a for j, v, s in b if None not in (u, v, t, s) and u == v and lower <= s - t <= upper)
    assert sorted(map(tuple, got.collect())) == want and got.columns == ["u", "a", "at", "b", "bt", "gap"]


def test_interval_join_is_an_equi_join(spark):
    text = plan_text(catalog.q_view_purchase_pairs(spark, SF_SMALL))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    with pytest.raises(ValueError):
        intervals.interval_join(spark.range(1), spark.range(1), (), "id", "id", 0, 1)


# --- sessions and windows -------------------------------------------------------------


def slow_sessions(rows, gap):
    out = []
    for key in {k for k, t in rows}:
        times = sorted(t for k, t in rows if k == key and t is not None)
        for i, t in enumerate(times):
            if i and t - times[i - 1] <= gap:
                out[-1] = (key, out[-1][1], t, out[-1][3] + 1)
            else:
                out.append((key, t, t, 1))
    return sorted(out, key=repr)


@pytest.mark.parametrize("gap", [1, 3, 10, 1000])
def test_sessions_match_brute_force(spark, gap):
    rnd = random.Random(gap)
    rows = [(rnd.choice(["a", "b", "hot", "hot", None]), rnd.choice([rnd.randrange(-100, 900), None])) for _ in range(300)]
    rows += [("edge", t) for t in (0, gap, 2 * gap, 3 * gap + 1)]
    got = sessions.sessionize(spark.createDataFrame(rows, "k string, t long").repartition(3), ("k",), "t", gap)
    assert sorted(map(tuple, got.collect()), key=repr) == slow_sessions(rows, gap)


def test_session_facts_meet_a_hash_aggregation_first(spark):
    """No window over raw rows: below the first exchange stands a partial aggregation."""
    text = plan_text(catalog.q_user_sessions(spark, SF_SMALL))
    tree = text.split("\n\n")[0].splitlines()
    at = max(i for i, x in enumerate(tree) if "Exchange" in x)
    assert any("HashAggregate" in x for x in tree[at:]) and not any("Window" in x for x in tree[at:])


def slow_windows(rows, width, slide, delay):
    marks, latest = {}, None
    for b in sorted({r[2] for r in rows}):
        marks[b] = None if latest is None else latest - delay
        new = [t for _, t, x in rows if x == b and t is not None]
        latest = max([*new, *([] if latest is None else [latest])], default=latest)
    n, late = Counter(), Counter()
    for k, t, b in rows:
        if t is not None:
            for start in range((t - width) // slide * slide, t + 1, slide):
                if start <= t < start + width:
                    n[k, start] += 1
                    late[k, start] += marks[b] is not None and start + width <= marks[b]
    return sorted((k, s, n[k, s] - late[k, s], late[k, s]) for k, s in n)


@pytest.mark.parametrize("width, slide, delay", [(10, 10, 0), (10, 3, 5), (7, 7, 30), (6, 9, 2), (12, 4, 0)])
def test_windows_match_a_replay(spark, width, slide, delay):
    rnd = random.Random(width)
    rows = [(rnd.choice("abc"), rnd.choice([None, *[b * 10 + rnd.randrange(-25, 10)] * 9]), b) for b in range(12) for _ in range(25)]
    df = spark.createDataFrame(rows, "k string, t long, b long").repartition(3)
    got = sorted(map(tuple, windows.windowed_counts(df, ("k",), "t", width, slide, "b", delay).collect()))
    assert got == slow_windows(rows, width, slide, delay) and (delay or sum(r[3] for r in got))
    plain = windows.windowed_counts(df, ("k",), "t", width, slide).collect()
    assert sorted((r.k, r.window_start, r.n + r.n_late) for r in plain) == [(k, s, n + late) for k, s, n, late in got]


def test_windows_equal_the_engines_own(spark):
    df = derived.log(spark, SF_SMALL)
    ours = windows.windowed_counts(df, ("event_name",), "ts", DAY, 6 * HOUR)
    theirs = df.groupBy("event_name", F.window("ts", "1 day", "6 hours")).count()
    start = theirs.select("event_name", micros(F.col("window.start"), df.schema["ts"].dataType).alias("s"), "count")
    assert sorted((r.event_name, r.window_start, r.n) for r in ours.collect()) == sorted(map(tuple, start.collect()))


# --- sketches, cubes, top lists ---------------------------------------------------------


def test_sketch_error_against_exact_counts(spark):
    """Weekly unions of stored daily sketches: within four standard errors for 30,000 users, nearly exact for few."""
    days = spark.range(120_000).select(F.lit("a").alias("event_name"), F.concat(F.lit("2024-01-0"), (F.col("id") % 7 + 1).cast("string")).alias("dt"),
                                       F.concat(F.lit("u"), (F.col("id") * 7919 % 30_000).cast("string")).alias("uid"))
    daily = sketches.user_sketches(days)
    assert daily.count() == 7 and daily.agg(F.max(F.length("sketch"))).first()[0] < (1 << sketches.LG_K) + 64
    row = sketches.roll_up(daily, ("event_name",)).select(sketches.estimate().alias("n"), "n_events").first()
    exact = days.select(F.countDistinct("uid")).first()[0]
    assert abs(row.n - exact) <= 4 * sketches.standard_error() * exact and row.n_events == 120_000
    small = spark.createDataFrame([("a", "d1", "x"), ("a", "d2", "x"), ("a", "d2", None)], "event_name string, dt string, uid string")
    assert sketches.roll_up(sketches.user_sketches(small), ("event_name",)).select(sketches.estimate()).first()[0] == 1


def slow_sets(rows, dims, sets):
    out = []
    for s in sets:
        pv, uv = Counter(), defaultdict(set)
        for r in rows:
            key = tuple(r[d] if d in s else None for d in dims)
            pv[key] += 1
            uv[key] |= {r["uid"]} - {None}
        gid = int("".join("0" if d in s else "1" for d in dims), 2)
        out += [(*k, gid, pv[k], len(uv[k])) for k in (pv or ([(None,) * len(dims)] if not s else []))]
    return sorted(out, key=repr)


@pytest.mark.parametrize("kind", [cubes.cube_sets, cubes.rollup_sets, lambda d: [d[:1], d[2:], ()]])
def test_grouping_sets_match_brute_force(spark, kind):
    rnd = random.Random(2)
    dims = ("a", "b", "c")
    rows = [{"a": rnd.choice(["x", "y", None]), "b": rnd.randrange(3), "c": rnd.choice(["p", "q"]), "uid": rnd.choice(["u1", "u2", "u3", None])}
            for _ in range(80)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "a string, b int, c string, uid string").repartition(3)
    got = cubes.grouping_sets(df, dims, kind(dims))
    assert sorted(map(tuple, got.collect()), key=repr) == slow_sets(rows, dims, kind(dims))
    empty = cubes.grouping_sets(df.where("false"), dims, kind(dims)).collect()
    assert [tuple(r) for r in empty] == [(None, None, None, 7, 0, 0)]


def test_cube_never_expands(spark):
    assert "Expand" not in plan_text(catalog.q_activity_cube(spark, SF_SMALL))


def test_top_k_is_exact_with_ties(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["hot", "hot", "hot", "cold", None]), rnd.randrange(6), i) for i in range(500)]
    got = topk.top_k(spark.createDataFrame(rows, "g string, n int, i int").repartition(4), ("g",), [F.desc("n"), F.col("i")], 7)
    want = [(g, -n, i, k) for g in {r[0] for r in rows}
            for k, (n, i) in enumerate(sorted((-n, i) for h, n, i in rows if h == g)[:7], 1)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert "WindowGroupLimit" in plan_text(got)


@pytest.mark.parametrize("share", [0.02, 0.1, 0.34])
def test_heavy_hitters_are_exact(spark, share):
    rnd = random.Random(9)
    values = [rnd.choice(["hot"] * 5 + [None] * 2 + [f"v{rnd.randrange(400)}", f"w{int(rnd.paretovariate(1.1))}"]) for _ in range(3000)]
    got = topk.heavy_hitters(spark.createDataFrame([(v,) for v in values], "v string").repartition(6), "v", share)
    assert {tuple(r) for r in got.collect()} == {(v, n) for v, n in Counter(values).items() if n > share * len(values)}
    few = topk.heavy_candidates(spark.createDataFrame([(v,) for v in values], "v string").repartition(6), "v", share)
    assert few.count() <= 6 * int(1 / share)
    assert topk.heavy_hitters(spark.createDataFrame([], "v string"), "v", share).collect() == []


def test_misra_gries_keeps_what_is_heavy():
    rnd = random.Random(1)
    for size in (1, 3, 10):
        counts, seen = {}, Counter()
        for _ in range(30):
            more = Counter(rnd.choice("aab" + "cdefghijklmnop"[:rnd.randrange(1, 14)]) for _ in range(40))
            seen += more
            counts = topk.misra_gries(counts, more.items(), size)
            assert len(counts) <= size
            assert {v for v, n in seen.items() if n > seen.total() / (size + 1)} <= set(counts)


def test_latest_per_key_shuffles_keys_not_values(spark):
    lg = derived.log(spark, SF_SMALL)
    rows = [(r.event_name, r.uid, r.seq) for r in lg.collect()]
    got = metrics.latest_per_key(lg, ["event_name"], "uid", "seq")
    want = {k: max((s, u) for a, u, s in rows if a == k)[1] for k in {r[0] for r in rows}}
    assert {r.event_name: r.value for r in got.collect()} == want


def test_times_outside_the_epoch_and_zone(spark):
    """Timestamps with and without zone give the same sessions."""
    rows = [("a", START + timedelta(minutes=m)) for m in (0, 5, 100, 104)]
    ntz = spark.createDataFrame(rows, "k string, t timestamp_ntz")
    found = sorted(map(tuple, sessions.sessionize(ntz, ("k",), "t", 10 * 60 * 10**6).collect()))
    assert [(r[2] - r[1], r[3]) for r in found] == [(300 * 10**6, 2), (240 * 10**6, 2)]
    zoned = ntz.select("k", F.col("t").cast("timestamp").alias("t"))
    assert sorted(map(tuple, sessions.sessionize(zoned, ("k",), "t", 10 * 60 * 10**6).collect())) == found
