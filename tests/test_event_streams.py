"""Sessions, windows, repeats, expiring counts and waiting events on streams: equal to a replay, also after restarts."""

import os
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F

from driftlog.operators import sessions, windows
from driftlog.session import STREAM_CONF, numbered_folders
from driftlog.streaming.timers import _RunningCounts, expiring_counts_stream, named_when_known_stream
from driftlog.streaming.windows import WindowStore, first_copies_stream, sessions_stream, windowed_counts_stream

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
BASE = 1_700_000_000_000_000  # microseconds
SECOND = 1_000_000


def at(seconds):
    return EPOCH + timedelta(microseconds=BASE + seconds * SECOND)


@pytest.fixture()
def rocks(spark):
    before = {k: spark.conf.get(k, None) for k in STREAM_CONF}
    for k, v in STREAM_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def feed(spark, folder, schema, files, first=0):
    """Write one file per list of rows, in order of arrival."""
    os.makedirs(folder, exist_ok=True)
    for n, rows in enumerate(files, first):
        part = f"{folder}-part{n}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(part)
        name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        os.rename(os.path.join(part, name), os.path.join(folder, f"{n:04d}.parquet"))


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def drain(df, out, checkpoint):
    q = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(out)
    q.awaitTermination()
    assert q.exception() is None


def test_sessions_stream_equals_batch_with_a_restart(rocks, workdir):
    """Rows of 60 minutes, dealt out of order within the watermark; the query is stopped and started again half way."""
    spark, schema, gap = rocks, "k string, t timestamp", 90 * SECOND
    rnd = random.Random(3)
    rows = sorted(((rnd.choice(["a", "b", "hot", "hot"]), rnd.randrange(3600)) for _ in range(240)), key=lambda r: r[1] + rnd.randrange(60))
    rows += [("edge", s) for s in (3600, 3690, 3781)]  # exactly the gap, and a second more
    files = [[(k, at(s)) for k, s in rows[i:i + 40]] for i in range(0, len(rows), 40)]
    files.append([("flush", at(100_000))])
    src, out, ck = (os.path.join(workdir, x) for x in ("in", "out", "ck"))
    feed(spark, src, schema, files[:4])
    df = sessions_stream(stream(spark, src, schema), ("k",), "t", gap, 120 * SECOND)
    drain(df, out, ck)
    feed(spark, src, schema, files[4:], 4)
    drain(df, out, ck)
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    batch = spark.createDataFrame([(k, at(s)) for k, s in rows], schema)
    assert got == sorted(map(tuple, sessions.sessionize(batch, ("k",), "t", gap).collect()))


def test_window_store_equals_replay(spark, workdir):
    """Counts and late rows of a stream, over a restart, a replayed batch and folding, equal the batch form by arrival."""
    schema = "k string, t timestamp"
    rnd = random.Random(7)
    files = [[(rnd.choice("ab"), at(b * 60 + rnd.randrange(-200, 60))) for _ in range(30)] for b in range(6)]
    src, root, ck = (os.path.join(workdir, x) for x in ("in", "store", "ck"))
    width, slide, delay = 120 * SECOND, 60 * SECOND, 60 * SECOND

    def store():
        return WindowStore(spark, root, ("k",), "t", width, slide, delay)

    feed(spark, src, schema, files[:3])
    windowed_counts_stream(stream(spark, src, schema), store(), ck).awaitTermination()
    store().fold()
    feed(spark, src, schema, files[3:], 3)
    windowed_counts_stream(stream(spark, src, schema), store(), ck).awaitTermination()
    rows = [(k, t, b) for b, some in enumerate(files) for k, t in some]
    want = windows.windowed_counts(spark.createDataFrame(rows, schema + ", b long"), ("k",), "t", width, slide, "b", delay)
    want = sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, store().table().collect())) == want and sum(r[3] for r in want)
    store().write(spark.createDataFrame(files[5], schema), 5)  # the last batch once more, as after a crash
    assert sorted(map(tuple, store().table().collect())) == want
    store().fold()
    store().fold()
    assert sorted(map(tuple, store().table().collect())) == want
    assert numbered_folders(spark, f"{root}/folded", "upto") == [2, 5]
    latest = max(t for some in files for _, t in some)
    closed = {r.window_start for r in store().table(closed_only=True).collect()}
    assert closed == {r[1] for r in want if EPOCH + timedelta(microseconds=r[1] + width + delay) <= latest}


def test_replayed_files_give_first_copies_only(rocks, workdir):
    """The same topic file arrives again twice; only first copies come out, and the state behind the watermark is gone."""
    spark, schema = rocks, "part int, place long, t timestamp, value string"
    files = [[(p, n * 10 + i, at(n * 50 + i), f"{p}-{n}-{i}") for p in (0, 1) for i in range(10)] for n in range(5)]
    order = [files[0], files[1], files[0], files[1] + files[1], files[2], files[3], files[2], files[4], [(9, 0, at(100_000), "flush")], [(9, 1, at(100_001), "end")]]
    src, out, ck = (os.path.join(workdir, x) for x in ("in", "out", "ck"))
    feed(spark, src, schema, order)
    df = first_copies_stream(stream(spark, src, schema), ("part", "place"), "t", 120 * SECOND)
    q = df.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out)
    q.awaitTermination()
    got = sorted(r.value for r in spark.read.parquet(out).collect())
    assert got == sorted([r[3] for f in files for r in f] + ["flush", "end"])
    assert [p.stateOperators[0].numRowsTotal for p in q.recentProgress][-1] <= 2


def replay_counts(rows, idle):
    """Running counts per (key, item) in order of arrival batch, then time; anew after an idle gap."""
    state, out = {}, []
    for batch in rows:
        for seq, k, item, s in sorted(batch, key=lambda r: (r[3], r[0])):
            count, last = state.get((k, item), (0, None))
            count = 1 if last is None or s - last > idle else count + 1
            state[k, item] = (count, s if last is None else max(s, last))
            out.append((seq, k, item, count))
    return sorted(out)


def test_expiring_counts_equal_a_replay_over_a_restart(rocks, workdir):
    spark, schema = rocks, "seq long, k string, item string, t timestamp"
    rnd = random.Random(11)
    files, seq = [], 0
    for b in range(6):
        files.append([])
        for _ in range(40):
            files[-1].append((seq, rnd.choice(["u1", "u2", "hot", "hot"]), rnd.choice(["click", "view"]), b * 100 + rnd.randrange(100)))
            seq += 1
    files.append([(seq, "flush", "view", 50_000)])
    src, out, ck = (os.path.join(workdir, x) for x in ("in", "out", "ck"))
    rows = [[(s, k, i, at(t)) for s, k, i, t in f] for f in files]
    feed(spark, src, schema, rows[:3])
    df = expiring_counts_stream(stream(spark, src, schema), ("k",), "item", "seq", "t", 15 * SECOND, 200 * SECOND)
    drain(df, out, ck)
    feed(spark, src, schema, rows[3:], 3)
    drain(df, out, ck)
    got = sorted((r.seq, r.k, r.item, r.cnt) for r in spark.read.parquet(out).collect())
    want = replay_counts(files, 15)
    assert got == want and {c for _, _, _, c in want} >= {1, 2, 3}


def test_expiring_counts_of_many_keys_cost_few_state_calls():
    """The state of a bucket is read and written once, whatever the number of its keys."""
    calls, held = Counter(), {}

    class Handle:
        def getValueState(self, name, schema, ttl=None):
            return self

        def get(self):
            calls["get"] += 1
            return held.get("value")

        def update(self, value):
            calls["update"] += 1
            held["value"] = value

        def registerTimer(self, at):
            calls["timer"] += 1

    counts = _RunningCounts(15 * 1_000_000, 1)
    counts.init(Handle())
    rows = pd.DataFrame({"key": [f"k{i % 500}" for i in range(2000)], "item": [f"i{i % 3}" for i in range(2000)], "seq": range(2000),
                         "no_seq": False, "key0": [f"k{i % 500}" for i in range(2000)], "us": range(2000)})
    found = [pd.concat(counts.handleInputRows((0,), iter([part]), None)) for part in (rows[:1500], rows[1500:])]
    assert calls == {"get": 2, "update": 2, "timer": 1}
    want = rows.groupby(["key", "item"]).cumcount() + 1
    assert pd.concat(found)["cnt"].tolist() == want.tolist()


def test_expiring_counts_of_null_and_long_keys_in_shared_buckets(rocks, workdir):
    spark, schema, big = rocks, "seq long, k long, n string, item string, t timestamp", (1 << 60) + 1
    rnd = random.Random(5)
    rows = [(None if i % 40 == 7 else big + i, rnd.choice([None, big, big + 1, 3]), rnd.choice([None, "a", '"b', "a,b"]),
             rnd.choice([None, "view"]), rnd.randrange(100)) for i in range(300)]
    src, out, ck = (os.path.join(workdir, x) for x in ("in", "out", "ck"))
    feed(spark, src, schema, [[(*r[:4], at(r[4])) for r in rows]])
    drain(expiring_counts_stream(stream(spark, src, schema), ("k", "n"), "item", "seq", "t", 2 * SECOND, 200 * SECOND, buckets=2), out, ck)
    want, state = [], {}
    for seq, k, n, item, s in sorted(rows, key=lambda r: (r[4], r[0] is None, r[0] or 0)):
        count, last = state.get((k, n, item), (0, -100))
        state[k, n, item] = (1 if s - last > 2 else count + 1, s)
        want.append((seq, k, n, item, state[k, n, item][0]))
    got = [(r.seq, r.k, r.n, r.item, r.cnt) for r in spark.read.parquet(out).collect()]
    assert Counter(got) == Counter(want)


@pytest.mark.parametrize("parts", [1, 3])
def test_waiting_events_come_out_once(rocks, workdir, parts):
    """Events and names arrive interleaved in any order; each event leaves once, named if its name came in time."""
    spark = rocks
    event, name = "seq long, id string, t timestamp", "id string, name string, vt timestamp"
    rnd = random.Random(parts)
    named_at = {"a": 0, "b": 150, "hot": 320, "late": 900}  # the second at which the name of each id comes; "none" gets no name
    events = [(i, rnd.choice(["a", "b", "hot", "hot", "none", "late"]), rnd.randrange(600)) for i in range(200)]
    e_files, n_files = [[] for _ in range(12)], [[] for _ in range(12)]
    for i, k, s in events:
        e_files[s // 100].append((i, k, at(s)))
    for k, s in named_at.items():
        n_files[s // 100].append((k, f"{k}-name", at(s)))
    for some in e_files:
        rnd.shuffle(some)
    e_files.append([(10_000, "flush", at(100_000))])
    n_files.append([("flush", "flush-name", at(100_000))])
    src_e, src_n, out, ck = (os.path.join(workdir, x) for x in ("events", "names", "out", "ck"))

    def run():
        df = named_when_known_stream(stream(spark, src_e, event), stream(spark, src_n, name), "id", "seq", "t", "name", "vt",
                                     200 * SECOND, 150 * SECOND, parts)
        drain(df, out, ck)

    feed(spark, src_e, event, e_files[:5])
    feed(spark, src_n, name, n_files[:5])
    run()
    feed(spark, src_e, event, e_files[5:], 5)
    feed(spark, src_n, name, n_files[5:], 5)
    run()
    got = defaultdict(list)
    for r in spark.read.parquet(out).where("seq < 10000").collect():
        got[r.seq].append((r.id, r.name))
    assert sorted(got) == [e[0] for e in events] and all(len(v) == 1 for v in got.values())
    for i, k, s in events:
        if k in ("a", "b"):  # names come less than the wait after any of their events
            assert got[i] == [(k, f"{k}-name")]
        if k == "hot" and s >= 200:
            assert got[i] == [(k, "hot-name")]
        if k in ("none", "late"):
            assert got[i] == [(k, None)]
