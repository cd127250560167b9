"""Streaming twins: the same rows fed as several files give the batch results."""

import os

import pytest
from pyspark.sql import functions as F

from cases import SF_SMALL
from driftlog.operators import dictionary, places, route, sinks
from driftlog.plans import derived
from driftlog.plans.flagship import scoreboard_from_lines
from driftlog.sources.protobuf import encode_log_batches
from driftlog.streaming.control import parse_job_args, run_with_restarts, trigger_of
from driftlog.streaming.jobs import board_table, enrich_stream, scoreboard_stream, split_archive_stream


def _split_files(df, path, order_col, parts):
    """Write ``df`` as ``parts`` files in ``order_col`` order (oldest file first)."""
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    step = (hi - lo) // parts + 1
    for i in range(parts):
        chunk = df.where((F.col(order_col) >= lo + i * step) & (F.col(order_col) < lo + (i + 1) * step))
        chunk.coalesce(1).write.mode("overwrite").parquet(os.path.join(path, f"part{i}"))
        # move each chunk's file to the stream folder, in order
        for f in sorted(os.listdir(os.path.join(path, f"part{i}"))):
            if f.endswith(".parquet"):
                os.rename(os.path.join(path, f"part{i}", f), os.path.join(path, "in", f"{i:03d}.parquet"))


def _stream_dir(workdir):
    os.makedirs(os.path.join(workdir, "in"), exist_ok=True)
    return os.path.join(workdir, "in")


def _run(q):
    q.awaitTermination()


def test_scoreboard_stream_equals_batch(spark, workdir):
    lines = derived.csv_lines(spark, SF_SMALL)
    names = dictionary.latest_names(derived.dictionary(spark, SF_SMALL))
    src = _stream_dir(workdir)
    _split_files(lines, workdir, "seq", 5)
    stream = spark.readStream.schema("seq long, line string").option("maxFilesPerTrigger", 1).parquet(src)
    changes = os.path.join(workdir, "changes")
    q = scoreboard_stream(stream, names, changes, os.path.join(workdir, "ck"), trigger={"availableNow": True})
    _run(q)
    got = {tuple(r) for r in board_table(spark, changes).collect()}
    want = {tuple(r) for r in scoreboard_from_lines(lines, names).collect()}
    assert got == want and len(got) > 0
    assert len([d for d in os.listdir(changes) if d.startswith("batch_id=")]) == 5
    from driftlog.streaming.jobs import compact_changes
    snap = os.path.join(workdir, "snapshot")
    compact_changes(spark, changes, snap)
    assert {tuple(r) for r in board_table(spark, changes, snap).collect()} == want


def test_scoreboard_restart_is_idempotent(spark, workdir):
    lines = derived.csv_lines(spark, SF_SMALL)
    names = dictionary.latest_names(derived.dictionary(spark, SF_SMALL))
    src = _stream_dir(workdir)
    _split_files(lines, workdir, "seq", 4)
    changes, ck = os.path.join(workdir, "changes"), os.path.join(workdir, "ck")
    failed = []

    def drill(batch_id):
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("failure drill after writing batch 2")

    def start():
        s = spark.readStream.schema("seq long, line string").option("maxFilesPerTrigger", 1).parquet(src)
        return scoreboard_stream(s, names, changes, ck, trigger={"availableNow": True}, after_batch=drill)

    restarts = run_with_restarts(start, restart_count=1, delay_ms=0, until=_run)
    assert restarts == 1 and failed == [2]
    got = {tuple(r) for r in board_table(spark, changes).collect()}
    want = {tuple(r) for r in scoreboard_from_lines(lines, names).collect()}
    assert got == want


@pytest.mark.parametrize("incremental", [False, True])
def test_enrich_stream_equals_batch(spark, workdir, incremental):
    lg = derived.log_geo(spark, SF_SMALL)
    beans = lg.select("seq", "uid", F.col("type_id").alias("event_id"), F.col("lon").alias("longitude"),
                      F.col("lat").alias("latitude"))
    payloads = encode_log_batches(beans.repartition(4), rows_per_batch=50) \
        .withColumn("seq", F.monotonically_increasing_id())
    payload_path = os.path.join(workdir, "payloads")
    payloads.write.parquet(payload_path)
    src = _stream_dir(workdir)
    for i, f in enumerate(sorted(x for x in os.listdir(payload_path) if x.endswith(".parquet"))):
        os.rename(os.path.join(payload_path, f), os.path.join(src, f"{i:03d}.parquet"))
    place_path = os.path.join(workdir, "places")
    derived.places(spark, SF_SMALL).write.parquet(place_path)
    dict_path = os.path.join(workdir, "dict")
    derived.dictionary(spark, SF_SMALL).write.parquet(dict_path)
    out = os.path.join(workdir, "out")
    stream = spark.readStream.schema("payload binary, seq long").option("maxFilesPerTrigger", 2).parquet(src)
    inc = None
    if incremental:
        from driftlog.sources.dictionary import IncrementalNames
        inc = IncrementalNames(spark, lambda: spark.read.parquet(dict_path), os.path.join(workdir, "names"))
    q = enrich_stream(stream, lambda: spark.read.parquet(place_path), lambda: spark.read.parquet(dict_path),
                      out, os.path.join(workdir, "ck"), trigger={"availableNow": True}, incremental_names=inc)
    _run(q)
    cols = ["uid", "event_id", "event_name", "province", "city", "district", "longitude", "latitude"]
    got = sorted((tuple(r) for r in spark.read.parquet(out).select(*cols).collect()), key=repr)
    names = dictionary.latest_names(derived.dictionary(spark, SF_SMALL))
    batch = places.enrich_places(lg, derived.places(spark, SF_SMALL))
    batch = dictionary.lookup_event_names(batch, names, out_col="event_name_x")
    want = sorted((tuple(r) for r in batch.select("uid", F.col("type_id").alias("event_id"),
                                                 F.col("event_name_x").alias("event_name"), "province", "city",
                                                 "district", F.col("lon").alias("longitude"),
                                                 F.col("lat").alias("latitude")).collect()), key=repr)
    assert got == want


def test_split_archive_stream_equals_batch(spark, workdir):
    lines = derived.json_lines(spark, SF_SMALL).join(derived.log(spark, SF_SMALL).select("seq", "ts"), "seq")
    src = _stream_dir(workdir)
    _split_files(lines, workdir, "seq", 3)
    place_path = os.path.join(workdir, "places")
    derived.places(spark, SF_SMALL).write.parquet(place_path)
    routes_out, archive_out = os.path.join(workdir, "routes"), os.path.join(workdir, "archive")
    stream = spark.readStream.schema("seq long, line string, ts timestamp_ntz") \
        .option("maxFilesPerTrigger", 1).parquet(src)
    q = split_archive_stream(stream, lambda: spark.read.parquet(place_path), routes_out, archive_out,
                             os.path.join(workdir, "ck"), clock="ts", trigger={"availableNow": True})
    _run(q)
    from driftlog.operators.decode import parse_json_events
    parsed = parse_json_events(lines, keep=("seq", "ts"))
    want_hours = {(r.bucket, r.n) for r in sinks.with_archive_bucket(parsed, clock="ts")
                  .groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    back = sinks.read_stream_archive(spark, archive_out)
    got_hours = {(r.bucket, r.n) for r in back.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got_hours == want_hours
    want_routes = {r.route: r.n for r in route.route_counts(route.route_events(parsed, "event_type")).collect()}
    got_routes = {r.route: r.n for r in spark.read.parquet(routes_out).groupBy("route").count()
                  .withColumnRenamed("count", "n").collect()}
    assert got_routes == {k: v for k, v in want_routes.items() if k != "main"}
    assert sum(n for _, n in got_hours) == want_routes["main"]


def test_job_args():
    opts = parse_job_args(["--topics", "a,b", "--restart_count", "3", "--bootstrap.servers", "h:9092"])
    assert opts == {"topics": "a,b", "restart_count": "3", "bootstrap.servers": "h:9092"}
    assert trigger_of(opts) == {"processingTime": "5000 milliseconds"}
    with pytest.raises(ValueError):
        parse_job_args(["--topics", "a"])
    from driftlog.sources.kafka import source_options
    k = source_options(opts)
    assert k["subscribe"] == "a,b" and k["startingOffsets"] == "earliest"
    assert k["kafka.bootstrap.servers"] == "h:9092" and "kafka.restart_count" not in k


def test_cli_scoreboard_on_files(spark, workdir):
    from driftlog.streaming.cli import main
    lines = derived.csv_lines(spark, SF_SMALL)
    src = _stream_dir(workdir)
    _split_files(lines, workdir, "seq", 2)
    dict_path = os.path.join(workdir, "dict")
    derived.dictionary(spark, SF_SMALL).write.parquet(dict_path)
    out = os.path.join(workdir, "out")
    rc = main(["scoreboard", "--restart_count", "0", "--source", "files", "--input", src,
               "--dictionary", dict_path, "--output", out, "--once", "true",
               "--checkpoint", os.path.join(workdir, "ck")], spark=spark)
    assert rc == 0
    names = dictionary.latest_names(derived.dictionary(spark, SF_SMALL))
    got = {tuple(r) for r in board_table(spark, os.path.join(out, "changes")).collect()}
    assert got == {tuple(r) for r in scoreboard_from_lines(lines, names).collect()}


def test_per_row_running_count_stream(spark, workdir):
    from driftlog.operators.decode import parse_csv_events
    from driftlog.operators.metrics import running_count
    from driftlog.streaming.stateful import running_count_rows
    lg = derived.log(spark, SF_SMALL).select("seq", "uid", "event_name", "event_type", "dt",
                                             F.concat_ws(",", "uid", "event_name", "time", "event_type",
                                                         "province").alias("line"))
    src = _stream_dir(workdir)
    _split_files(lg.select("seq", "line"), workdir, "seq", 3)
    stream = spark.readStream.schema("seq long, line string").option("maxFilesPerTrigger", 1).parquet(src)
    rows = parse_csv_events(stream).select("seq", "uid", "event_name", F.col("type_id").alias("event_type"),
                                           F.substring("time", 1, 10).alias("dt"))
    out = os.path.join(workdir, "rows")
    q = (running_count_rows(rows).writeStream.outputMode("append").format("parquet")
         .option("path", out).option("checkpointLocation", os.path.join(workdir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(out).select("seq", "first_dt", "cnt").collect()}
    want = {tuple(r) for r in running_count(lg).select("seq", "first_dt", "cnt").collect()}
    assert got == want and len(got) == lg.count()


def test_console_sink(spark, capsys):
    from driftlog.streaming.jobs import console_sink
    console_sink(2)(spark.range(50), 7)
    out = capsys.readouterr().out.split()
    assert "7:" in out and out[-50:] == [str(i) for i in range(50)]


def test_active_users_stream_equals_batch(spark, workdir):
    from driftlog.operators.metrics import active_users
    from driftlog.streaming.jobs import active_users_stream, uv_table
    lg = derived.log(spark, SF_SMALL).select("seq", "uid", "event_name", "event_type", "dt")
    src = _stream_dir(workdir)
    _split_files(lg, workdir, "seq", 3)
    stream = spark.readStream.schema("seq long, uid string, event_name string, event_type string, dt string") \
        .option("maxFilesPerTrigger", 1).parquet(src)
    changes = os.path.join(workdir, "uv")
    active_users_stream(stream, changes, os.path.join(workdir, "ck"), trigger={"availableNow": True}) \
        .awaitTermination()
    got = {tuple(r) for r in uv_table(spark, changes).collect()}
    want = {tuple(r) for r in active_users(lg).collect()}
    assert got == want and len(got) > 0


def test_scoreboard_rows_stream_equals_batch(spark, workdir):
    from driftlog.streaming.jobs import scoreboard_rows_stream
    lines = derived.csv_lines(spark, SF_SMALL)
    names = dictionary.latest_names(derived.dictionary(spark, SF_SMALL))
    src = _stream_dir(workdir)
    _split_files(lines, workdir, "seq", 3)
    stream = spark.readStream.schema("seq long, line string").option("maxFilesPerTrigger", 1).parquet(src)
    changes = os.path.join(workdir, "changes")
    scoreboard_rows_stream(stream, names, changes, os.path.join(workdir, "ck"),
                           trigger={"availableNow": True}).awaitTermination()
    got = {tuple(r) for r in board_table(spark, changes).collect()}
    want = {tuple(r) for r in scoreboard_from_lines(lines, names).collect()}
    assert got == want and len(got) > 0


def test_cli_enrich_and_split_archive_on_files(spark, workdir):
    from driftlog.streaming.cli import main
    place_path = os.path.join(workdir, "places")
    derived.places(spark, SF_SMALL).write.parquet(place_path)
    dict_path = os.path.join(workdir, "dict")
    derived.dictionary(spark, SF_SMALL).write.parquet(dict_path)
    # P1 input: protobuf batches
    lg = derived.log(spark, SF_SMALL)
    beans = lg.select("uid", F.col("type_id").alias("event_id"), F.col("lon").alias("longitude"),
                      F.col("lat").alias("latitude"))
    pin = os.path.join(workdir, "pin")
    encode_log_batches(beans).withColumn("seq", F.monotonically_increasing_id()).write.parquet(pin)
    out1 = os.path.join(workdir, "out1")
    assert main(["enrich", "--restart_count", "0", "--source", "files", "--input", pin, "--places", place_path,
                 "--dictionary", dict_path, "--output", out1, "--once", "true",
                 "--checkpoint", os.path.join(workdir, "ck1")], spark=spark) == 0
    assert spark.read.parquet(os.path.join(out1, "rows")).count() == lg.count()
    # P3 input: JSON lines
    jin = os.path.join(workdir, "jin")
    derived.json_lines(spark, SF_SMALL).write.parquet(jin)
    out3 = os.path.join(workdir, "out3")
    assert main(["split-archive", "--restart_count", "0", "--source", "files", "--input", jin,
                 "--places", place_path, "--output", out3, "--once", "true",
                 "--checkpoint", os.path.join(workdir, "ck3")], spark=spark) == 0
    from driftlog.operators.decode import parse_json_events
    n = parse_json_events(derived.json_lines(spark, SF_SMALL)).count()
    assert sinks.read_stream_archive(spark, os.path.join(out3, "archive")).count() == n


def test_kafka_trigger_bounds():
    from driftlog.sources.kafka import sink_options, source_options
    opts = {"topics": "logs", "bootstrap.servers": "h:9092", "max_offsets_per_trigger": "1000",
            "min_partitions": "64", "restart_count": "1"}
    k = source_options(opts, min_partitions=64, max_offsets_per_trigger=1000)
    assert k["maxOffsetsPerTrigger"] == "1000" and k["minPartitions"] == "64"
    assert not any(x.startswith("kafka.max") or x.startswith("kafka.min") for x in k)
    assert sink_options(opts) == {"kafka.bootstrap.servers": "h:9092"}
