import os

from pyspark.sql import functions as F

from driftlog.operators.route import route_counts, route_events, with_route
from driftlog.operators.sinks import kv_table, read_archive, to_topic_records, with_archive_bucket, write_archive


def test_routes(spark):
    df = spark.createDataFrame([(0, "flow_click"), (1, "acitiv_buy"), (2, "activity_buy"), (3, "error"), (4, None)],
                               "seq long, event_type string")
    side = {r.seq: r.route for r in with_route(df).collect()}
    assert side == {0: "flow", 1: "acitiv", 2: None, 3: None, 4: None}
    routed = sorted((r.seq, r.route) for r in route_events(df).collect())
    assert routed == [(0, "flow"), (0, "main"), (1, "acitiv"), (1, "main"), (2, "main"), (3, "main"), (4, "main")]
    assert dict(route_counts(route_events(df)).collect()) == {"main": 5, "flow": 1, "acitiv": 1}
    topics = to_topic_records(with_route(df).where("route is not null").withColumn("json", F.lit("{}")),
                              topics={"flow": "flow", "acitiv": "acitiv"})
    assert sorted(r.topic for r in topics.collect()) == ["acitiv", "flow"]


def test_archive_folders_round_trip(spark, workdir):
    df = spark.createDataFrame([(0, "2024-01-01 17:30:00", "a"), (1, "2024-01-01 15:59:59", "b"),
                                (2, "2024-01-01 16:00:00", "c")], "seq long, t string, line string") \
        .withColumn("ts", F.to_timestamp("t"))
    path = os.path.join(workdir, "arch")
    write_archive(with_archive_bucket(df, clock="ts"), path, max_records_per_file=1)
    folders = sorted(d for d in os.listdir(path) if d.startswith("bucket="))
    assert folders == ["bucket=2024-01-01--23", "bucket=2024-01-02--00", "bucket=2024-01-02--01"]
    back = {(r.bucket, r.value) for r in read_archive(spark, path).collect()}
    assert back == {("2024-01-02--01", "a"), ("2024-01-01--23", "b"), ("2024-01-02--00", "c")}


def test_kv_last_write_wins(spark):
    w = spark.createDataFrame([("k", "f", "1", 0), ("k", "f", "2", 5), ("k", "g", "9", 1), ("k", "f", "3", 2)],
                              "board_key string, event_type string, value string, seq long")
    assert {(r.event_type, r.value) for r in kv_table(w).collect()} == {("f", "2"), ("g", "9")}


def test_scale_conf():
    from driftlog.session import scale_conf
    c = scale_conf(100 * 10**12, executor_cores=8, executors=1000)
    assert int(c["spark.sql.shuffle.partitions"]) >= 16000
    assert int(c["spark.sql.shuffle.partitions"]) * 256 * 1024 * 1024 >= 100 * 10**12
    assert scale_conf(10, 4, 2)["spark.sql.shuffle.partitions"] == "16"
