"""Streams that lose nothing: resolvers, changing dictionaries, late rows, replays, shared storage."""

import os

import pytest
from pyspark.sql import functions as F

from driftlog.functions.geohash import with_geohash
from driftlog.operators import sinks
from driftlog.sources import kafka
from driftlog.sources.dictionary import IncrementalNames
from driftlog.streaming import jobs
from driftlog.streaming.control import run_with_restarts

NO_NAMES = "event_id string, event_name string, last_update string"


def _put(spark, rows, schema, folder, n):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def _stream(spark, schema, folder):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def counting_resolver(log):
    """Adds a line to a file for every cell it is asked for."""
    def resolve(cells):
        def call(batches):
            for pdf in batches:
                with open(log, "a") as f:
                    f.writelines(f"{c}\n" for c in pdf["geohash5"])
                yield pdf.assign(province="P" + pdf["geohash5"], city="c", district="d")[
                    ["geohash5", "province", "city", "district"]]
        return cells.mapInPandas(call, "geohash5 string, province string, city string, district string")
    return resolve


def test_resolver_is_called_once_per_new_cell(spark, workdir):
    src, out, store, log = (os.path.join(workdir, x) for x in ("in", "out", "places", "calls"))
    schema = "seq long, line string"
    want_cells = set()
    for n in range(3):  # every batch: ten cells of its own, and the first batch's again
        rows = []
        for i in range(20):
            lon = 10.0 * (n if i < 10 else 0) + i % 10
            rows.append((n * 20 + i, '{"uid":"u%d","eventType":"flow_x","jd":%.1f,"wd":20.0}' % (i, lon)))
            want_cells.add(lon)
        _put(spark, rows, schema, src, n)
    q = jobs.split_archive_stream(_stream(spark, schema, src), None, f"{out}/routes", f"{out}/archive",
                                  os.path.join(workdir, "ck"), trigger={"availableNow": True},
                                  resolver=counting_resolver(log), place_output=store)
    q.awaitTermination()
    calls = open(log).read().split()
    assert len(calls) == len(set(calls)) == len(want_cells)
    lines = sinks.read_stream_archive(spark, f"{out}/archive")
    assert lines.count() == 60
    assert lines.where(F.col("value").contains('"province":"P')).count() == 60
    table = sorted(map(tuple, jobs.PlaceStore(spark, store).table().collect()))
    assert len(table) == len({r[0] for r in table}) == len(want_cells)
    jobs.PlaceStore(spark, store).compact()
    assert sorted(map(tuple, jobs.PlaceStore(spark, store).table().collect())) == table


def test_scoreboard_sees_dictionary_rows_added_between_batches(spark, workdir):
    src, names_dir = os.path.join(workdir, "in"), os.path.join(workdir, "dict")
    schema = "seq long, line string"
    _put(spark, [("1", "view", "2024-01-01")], NO_NAMES, names_dir, 0)
    _put(spark, [(1, "a,act,2024-01-01 00:00:00,1,p"), (2, "a,act,2024-01-01 00:00:01,2,p")], schema, src, 0)
    poll = IncrementalNames(spark, lambda: spark.read.parquet(names_dir), os.path.join(workdir, "names"))
    named, changes, ck = (os.path.join(workdir, x) for x in ("named", "changes", "ck"))

    def step():
        jobs.named_stream(_stream(spark, schema, src), poll.refresh, named, ck + "/a",
                          trigger={"availableNow": True}).awaitTermination()
        jobs.counted_stream(spark, named, changes, ck + "/b", trigger={"availableNow": True}).awaitTermination()

    step()
    _put(spark, [("2", "click", "2024-01-02")], NO_NAMES, names_dir, 1)
    _put(spark, [(3, "a,act,2024-01-01 00:00:02,2,p"), (4, "a,act,2024-01-01 00:00:03,1,p")], schema, src, 1)
    step()
    board = {(r.board_key, r.event_type): r.value for r in jobs.board_table(spark, changes).collect()}
    assert board == {("act|2024-01-01", "view"): "2", ("act|2024-01-01", None): "1", ("act|2024-01-01", "click"): "1"}


LATE = [[(10, "a", "2024-01-02"), (11, "b", "2024-01-02")], [(5, "a", "2024-01-01"), (6, "b", "2024-01-01"), (7, "a", "2024-01-01")]]


@pytest.mark.parametrize("per_row", [False, True])
@pytest.mark.parametrize("decimal_order", [False, True])
def test_late_rows_arrive_last(spark, workdir, per_row, decimal_order):
    """A row with an older seq in a later batch is counted, and written, after the earlier batch."""
    src, changes = os.path.join(workdir, "in"), os.path.join(workdir, "changes")
    kind = "decimal(38,0)" if decimal_order else "bigint"
    for n, rows in enumerate(LATE):
        df = spark.createDataFrame([(s, f"{u},act,{d} 00:00:00,1,p") for s, u, d in rows], "seq long, line string")
        df.select(F.col("seq").cast(kind).alias("seq"), "line").coalesce(1).write.mode("append").parquet(src)
    names = spark.createDataFrame([("1", "view")], "event_id string, event_name string")
    start = jobs.scoreboard_rows_stream if per_row else jobs.scoreboard_stream
    start(_stream(spark, f"seq {kind}, line string", src), names, changes, os.path.join(workdir, "ck"),
          trigger={"availableNow": True}).awaitTermination()
    # arrival: a b | a b a  ->  the last row is a's third, and the first dates are those of the first batch
    board = [tuple(r) for r in jobs.board_table(spark, changes).collect()]
    assert board == [("act|2024-01-02", "view", "3")]
    snap = os.path.join(workdir, "snap")
    jobs.compact_changes(spark, changes, snap, trim=True)
    assert [tuple(r) for r in jobs.board_table(spark, changes, snap).collect()] == board


def test_kafka_order_is_one_number(spark):
    rows = [("2024-01-01 00:00:00", 1, 7, b"x"), ("2024-01-01 00:00:00", 0, 9, b"y"), ("2023-12-31 23:59:59.5", 5, 10 ** 15, b"z")]
    df = spark.createDataFrame(rows, "timestamp string, partition int, offset long, value binary") \
        .withColumn("timestamp", F.to_timestamp("timestamp"))
    got = [bytes(r.payload) for r in kafka.value_bytes(df).orderBy("seq").collect()]
    assert got == [b"z", b"y", b"x"]
    assert df.select(kafka.arrival_order().isNull().alias("n")).where("n").count() == 0


def test_refused_kafka_options_are_dropped():
    opts = {"topics": "t", "bootstrap.servers": "h:1", "auto.offset.reset": "latest", "enable.auto.commit": "false",
            "group.id": "g", "key.deserializer": "x", "fetch.min.bytes": "1"}
    source, sink = kafka.source_options(opts), kafka.sink_options(opts)
    assert source["startingOffsets"] == "latest" and source["kafka.group.id"] == "g"
    assert not {"kafka.auto.offset.reset", "kafka.enable.auto.commit", "kafka.key.deserializer"} & set(source)
    assert sink == {"kafka.bootstrap.servers": "h:1"}


def test_archive_replay_in_the_next_hour(spark, workdir):
    lines = spark.createDataFrame([("a", "h1"), ("b", "h1")], "line string, bucket string")
    sinks.write_archive_batch(lines, workdir, 0)
    sinks.write_archive_batch(lines.withColumn("bucket", F.lit("h2")), workdir, 0)
    assert sorted(map(tuple, sinks.read_stream_archive(spark, workdir).collect())) == [("a", "h2"), ("b", "h2")]


def test_archive_compaction_makes_few_files(spark, workdir):
    for n in range(12):
        rows = [(f"{n}-{i}", f"h{n // 6}") for i in range(10)]
        sinks.write_archive_batch(spark.createDataFrame(rows, "line string, bucket string").repartition(4), workdir, n)
    want = sorted(map(tuple, sinks.read_stream_archive(spark, workdir).collect()))
    sinks.compact_archive(spark, workdir)
    assert sorted(map(tuple, sinks.read_stream_archive(spark, workdir).collect())) == want and len(want) == 120
    merged = [f for d, _, names in os.walk(os.path.join(workdir, "merged")) for f in names if f.startswith("part-")]
    assert len(merged) <= 4
    assert [d for d in os.listdir(os.path.join(workdir, "batches")) if d.startswith("batch")] == ["batch=11"]


def test_archive_rolls_by_age_and_by_size(spark, workdir):
    """Due once the oldest batch that may be merged is old enough, or the batches are large enough; the newest doesn't count."""
    import time
    now = int(time.time() * 1000)
    assert not sinks.roll_due(spark, workdir, now_ms=now)
    for n in range(3):
        sinks.write_archive_batch(spark.createDataFrame([("x" * 100, "h")], "line string, bucket string"), workdir, n)
    assert not sinks.roll_due(spark, workdir, now_ms=now)
    assert sinks.roll_due(spark, workdir, now_ms=now + sinks.ROLL_MS + 120_000)
    assert sinks.roll_due(spark, workdir, roll_bytes=150, now_ms=now) and not sinks.roll_due(spark, workdir, roll_bytes=250, now_ms=now)
    sinks.compact_archive(spark, workdir)
    assert not sinks.roll_due(spark, workdir, now_ms=now + sinks.ROLL_MS + 120_000)


def test_place_store_keeps_the_first_place_of_a_cell(spark, workdir):
    """The base comes first, then the earliest batch; versions replace nothing that a reader may have open."""
    base = spark.createDataFrame([("c1", "base", "b", "b")], jobs.PLACE_SCHEMA)
    store = jobs.PlaceStore(spark, workdir, lambda: base)
    for n, cells in enumerate((("c1", "c2"), ("c2", "c3"), ("c3", "c4"), ("c4", "c1"))):
        rows = [(c, f"batch{n}", "x", "x") for c in cells]
        spark.createDataFrame(rows, jobs.PLACE_SCHEMA).write.parquet(os.path.join(workdir, f"batch_id={n}"))
    want = {"c1": "base", "c2": "batch0", "c3": "batch1", "c4": "batch2"}
    found = lambda before=None: {r.geohash5: r.province for r in store.table(before).collect()}
    assert found() == want and found(2) == {"c1": "base", "c2": "batch0", "c3": "batch1"}
    opened = store.table()
    store.compact()
    assert sorted(os.listdir(os.path.join(workdir, "merged"))) == ["upto=2"] and found() == want
    spark.createDataFrame([("c5", "batch4", "x", "x")], jobs.PLACE_SCHEMA).write.parquet(os.path.join(workdir, "batch_id=4"))
    spark.createDataFrame([("c6", "batch5", "x", "x")], jobs.PLACE_SCHEMA).write.parquet(os.path.join(workdir, "batch_id=5"))
    store.compact()
    store.compact()
    assert sorted(os.listdir(os.path.join(workdir, "merged"))) == ["upto=2", "upto=4"]
    assert found() == want | {"c5": "batch4", "c6": "batch5"}
    assert opened.columns == ["geohash5", "province", "city", "district"]


def test_restart_covers_a_failed_start():
    tries = []

    class Query:
        def awaitTermination(self):  # noqa: N802
            pass

    def start():
        tries.append(1)
        if len(tries) < 3:
            raise ConnectionError("away")
        return Query()

    assert run_with_restarts(start, restart_count=3, delay_ms=0) == 2
    with pytest.raises(ConnectionError):
        tries.clear()
        run_with_restarts(start, restart_count=1, delay_ms=0)


def test_staged_copy_is_deleted(spark):
    from driftlog.operators.joins import staged_for
    with staged_for(spark.range(5), "copy") as held:
        path = held.inputFiles()[0].removeprefix("file://")
        assert held.count() == 5 and os.path.exists(path)
    assert not os.path.exists(path)


def test_no_machine_local_folder_on_a_cluster():
    from driftlog.session import shared_root

    class Context:
        master = "yarn"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Conf:
        def get(self, *a):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()  # noqa: N815

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_cli_enrich_with_resolver_and_no_places(spark, workdir, capsys):
    from driftlog.sources.protobuf import encode_log_batches
    from driftlog.streaming.cli import main
    src = os.path.join(workdir, "in")
    beans = spark.createDataFrame([("u", "1", 10.0, 20.0), ("v", "1", 11.0, 20.0), ("w", "1", 10.0, 20.0)],
                                  "uid string, event_id string, longitude double, latitude double")
    encode_log_batches(beans.coalesce(1)).withColumn("seq", F.lit(1).cast("long")).write.parquet(src)
    _put(spark, [("1", "view", "2024-01-01")], NO_NAMES, os.path.join(workdir, "dict"), 0)
    out = os.path.join(workdir, "out")
    assert main(["enrich", "--restart_count", "0", "--source", "files", "--input", src,
                 "--dictionary", os.path.join(workdir, "dict"), "--resolver", "test_recovery:cli_resolver",
                 "--output", out, "--once", "true", "--checkpoint", os.path.join(workdir, "ck")], spark=spark) == 0
    rows = spark.read.parquet(f"{out}/rows").select("uid", "event_name", "province").collect()
    assert sorted(map(tuple, rows)) == [("u", "view", "P10.0"), ("v", "view", "P11.0"), ("w", "view", "P10.0")]


def cli_resolver(spark):
    return lambda cells: cells.select("geohash5", F.concat(F.lit("P"), F.col("lon").cast("string")).alias("province"),
                                      F.lit("c").alias("city"), F.lit("d").alias("district"))


def test_places_found_in_a_stream_of_protobuf(spark, workdir):
    from driftlog.sources.protobuf import encode_log_batches
    src, out, log = (os.path.join(workdir, x) for x in ("in", "out", "calls"))
    for n in range(2):
        beans = spark.createDataFrame([(f"u{n}", "1", 10.0, 20.0 + n)], "uid string, event_id string, longitude double, latitude double")
        encode_log_batches(beans).withColumn("seq", F.lit(n).cast("long")).coalesce(1).write.mode("append").parquet(src)
    names = spark.createDataFrame([("1", "view", "2024-01-01")], NO_NAMES)
    q = jobs.enrich_stream(_stream(spark, "payload binary, seq long", src), None, lambda: names, out, os.path.join(workdir, "ck"),
                           resolver=counting_resolver(log), place_output=os.path.join(workdir, "places"),
                           trigger={"availableNow": True})
    q.awaitTermination()
    want = {(r.uid, "P" + r.geohash5) for r in with_geohash(
        spark.createDataFrame([("u0", 20.0, 10.0), ("u1", 21.0, 10.0)], "uid string, lat double, lon double"), "lat", "lon").collect()}
    assert {(r.uid, r.province) for r in spark.read.parquet(out).collect()} == want
    assert len(open(log).read().split()) == 2


def test_active_users_drop_old_days(spark, workdir):
    src, changes = os.path.join(workdir, "in"), os.path.join(workdir, "uv")
    schema = "ts timestamp, uid string, event_name string, event_type string, dt string"
    import datetime as d
    for day in (1, 2, 9, 10):
        rows = [(d.datetime(2024, 1, day, 5), u, "act", "view", f"2024-01-{day:02d}") for u in ("a", "b", "a")]
        _put(spark, rows, schema, src, day)
    jobs.active_users_stream(_stream(spark, schema, src), changes, os.path.join(workdir, "ck"), event_time="ts",
                             trigger={"availableNow": True}).awaitTermination()
    got = {(r.dt, r.uv) for r in jobs.uv_table(spark, changes).collect()}
    assert got == {(f"2024-01-{x:02d}", 2) for x in (1, 2, 9, 10)}
