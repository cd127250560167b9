import random

from driftlog.operators.metrics import (active_users, activity_scoreboard, key_summary, page_views,
                                        running_count)

ROWS = [  # seq, uid, time, dt for activity n, type view (FIXTURES scoreboard example)
    (0, "a", "2024-01-01 00:00:00"),
    (1, "a", "2024-01-02 00:00:00"),
    (2, "b", "2024-01-01 09:00:00"),
    (3, "b", "2024-01-03 00:00:00"),
]


def _log(spark, rows=ROWS):
    data = [(s, u, "n", "view", t, t[:10]) for s, u, t in rows]
    return spark.createDataFrame(data, "seq long, uid string, event_name string, event_type string,"
                                       " time string, dt string")


def test_running_count_and_scoreboard_example(spark):
    rc = {r.seq: (r.cnt, r.first_dt) for r in running_count(_log(spark)).collect()}
    assert rc == {0: (1, "2024-01-01"), 1: (2, "2024-01-01"), 2: (1, "2024-01-01"), 3: (2, "2024-01-01")}
    board = [tuple(r) for r in activity_scoreboard(_log(spark)).collect()]
    assert board == [("n|2024-01-01", "view", "2")]


def test_active_users_example(spark):
    uv = {r.dt: r.uv for r in active_users(_log(spark)).collect()}
    assert uv == {"2024-01-01": 2, "2024-01-02": 1, "2024-01-03": 1}


def brute_running(rows):
    seen, first, out = {}, {}, {}
    for seq, uid, name, typ, dt in sorted(rows):
        k = (name, typ, uid)
        seen[k] = seen.get(k, 0) + 1
        first.setdefault(k, dt)
        out[seq] = (seen[k], first[k])
    return out


def test_running_count_blocks_match_brute_force(spark):
    rnd = random.Random(3)
    seqs = rnd.sample(range(5000), 1500)
    # one hot user holds about a third of the rows
    rows = [(s, "hot" if rnd.random() < 0.33 else f"u{rnd.randint(0, 40)}", f"a{rnd.randint(0, 2)}",
             rnd.choice(["view", "click"]), f"2024-01-{rnd.randint(10, 28)}") for s in seqs]
    df = spark.createDataFrame(rows, "seq long, uid string, event_name string, event_type string, dt string")
    want = brute_running(rows)
    for block in (7, 64, 1 << 20):
        got = {r.seq: (r.cnt, r.first_dt) for r in running_count(df, seq_block=block).collect()}
        assert got == want, block


def test_page_views_and_summary(spark):
    pv = {r.uid: r.pv for r in page_views(_log(spark)).collect()}
    assert pv == {"a": 2, "b": 2}
    s = {r.uid: (r.cnt, r.first_dt, r.last_seq) for r in key_summary(_log(spark)).collect()}
    assert s == {"a": (2, "2024-01-01", 1), "b": (2, "2024-01-01", 3)}


def test_approx_active_users_close_to_exact(spark):
    rows = [(i, f"u{i % 997}", "a", "view", "2024-01-01") for i in range(20000)]
    df = spark.createDataFrame(rows, "seq long, uid string, event_name string, event_type string, dt string")
    exact = active_users(df).first().uv
    approx = active_users(df, approx=True).first().uv
    assert exact == 997 and abs(approx - exact) / exact < 0.1


def test_public_operator_api():
    import driftlog.operators as ops
    assert all(callable(getattr(ops, n)) for n in ops.__all__)
