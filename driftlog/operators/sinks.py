"""Batch forms of the sinks: hourly text archive, keyed upsert table, topic routing.

Every folder writer here is idempotent for a given ``batch_id`` (re-running a
micro-batch after an executor or driver loss overwrites the same folder), so
folder sinks are exactly-once.  Records sent to a Kafka topic are not: a
replayed micro-batch sends them again (at least once); they are keyed by their
arrival order so that readers can drop the repeats.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlog.functions.text import hour_folder
from driftlog.operators.metrics import latest_per_key
from driftlog.session import conf_set, delete_path, folder_state, numbered_folders

# Archive folder pattern and zone, roll size in bytes and roll interval in milliseconds.
ARCHIVE_PATTERN = "yyyy-MM-dd--HH"
ARCHIVE_ZONE = "Asia/Shanghai"
ROLL_BYTES = 134_217_728
ROLL_MS = 3_000_000
#: Parts of an archive write may be this small, if there are cores for them.
SMALL_PART = "32k"


def with_archive_bucket(df: DataFrame, clock: Column | str | None = None,
                        out_col: str = "bucket", zone: str = ARCHIVE_ZONE,
                        pattern: str = ARCHIVE_PATTERN) -> DataFrame:
    """Hour folder of each row; ``clock=None`` means processing time."""
    ts = F.current_timestamp() if clock is None else (F.col(clock) if isinstance(clock, str) else clock)
    return df.withColumn(out_col, hour_folder(ts, zone, pattern))


def write_archive(df: DataFrame, path: str, line_col: str = "line", bucket_col: str = "bucket",
                  max_records_per_file: int | None = None, mode: str = "append") -> None:
    """Write text lines into ``path/bucket=<hour>/`` folders.

    Rows are rebalanced by hour: AQE joins small hours and splits a busy one by
    its real bytes, so the tree gets a few bounded files per hour instead of one
    per (task, hour), and no hour is one task's work.  Small hours are joined only
    as far as every core still has a part of them: opening files takes longer than
    writing them.  ``max_records_per_file`` bounds a file by rows as well.
    """
    out = df.select(F.col(line_col).alias("value"), F.col(bucket_col).alias("bucket")).hint("rebalance", "bucket")
    writer = out.write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    cores = df.sparkSession.sparkContext.defaultParallelism
    with conf_set(df.sparkSession, {"spark.sql.adaptive.coalescePartitions.minPartitionNum": str(cores),
                                    "spark.sql.adaptive.coalescePartitions.minPartitionSize": SMALL_PART}):
        writer.partitionBy("bucket").text(path)


def write_archive_batch(df: DataFrame, archive: str, batch_id: int, line_col: str = "line",
                        bucket_col: str = "bucket") -> None:
    """One micro-batch of the stream's archive: ``archive/batches/batch=N/bucket=H``.

    The whole batch folder is overwritten, so a batch replayed in a later hour
    leaves nothing of its first copy.  Rows are rebalanced by hour, so a batch of
    ordinary size is one file per hour it spans; ``compact_archive`` merges batches.
    """
    write_archive(df, f"{archive.rstrip('/')}/batches/batch={batch_id}", line_col, bucket_col, mode="overwrite")


def _archive_batches(spark: SparkSession, archive: str, ids: list[int]) -> DataFrame:
    root = f"{archive}/batches"
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("batch", T.LongType()),
                           T.StructField("bucket", T.StringType())])
    return (spark.read.schema(schema).option("basePath", root)
            .text([f"{root}/batch={n}" for n in ids]).select("value", "bucket"))


def _archive_segments(spark: SparkSession, archive: str) -> list[int]:
    return numbered_folders(spark, f"{archive.rstrip('/')}/merged", "upto")


def roll_due(spark: SparkSession, archive: str, roll_ms: int = ROLL_MS, roll_bytes: int = ROLL_BYTES, keep_last: int = 1,
             now_ms: int | None = None) -> bool:
    """Is it time to merge: is the oldest batch that can be merged ``roll_ms`` old, or are they ``roll_bytes`` together?"""
    root = archive.rstrip("/")
    upto = max(_archive_segments(spark, root), default=-1)
    ids = [n for n in numbered_folders(spark, f"{root}/batches", "batch") if n > upto]
    states = [folder_state(spark, f"{root}/batches/batch={n}") for n in (ids[:len(ids) - keep_last] if keep_last else ids)]
    if not states:
        return False
    now = int(time.time() * 1000) if now_ms is None else now_ms
    return now - min(t for t, _ in states) >= roll_ms or sum(n for _, n in states) >= roll_bytes


def compact_archive(spark: SparkSession, archive: str, roll_bytes: int = ROLL_BYTES, keep_last: int = 1) -> None:
    """Merge the stream's batch folders into hour files of about ``roll_bytes`` at most.

    The batches written since the last time become one segment
    ``archive/merged/upto=N/bucket=H``; what was merged before is not touched.
    The segment counts once it is complete, and only then its batch folders are
    deleted.  The ``keep_last`` newest batches stay as they are: a restarted query
    may write its last batch again.  Run it once an hour or so.
    """
    root = archive.rstrip("/")
    upto = max(_archive_segments(spark, root), default=-1)
    ids = [n for n in numbered_folders(spark, f"{root}/batches", "batch") if n > upto]
    ids = ids[:len(ids) - keep_last] if keep_last else ids
    if ids:
        with conf_set(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(roll_bytes)}):
            write_archive(_archive_batches(spark, root, ids), f"{root}/merged/upto={ids[-1]}", "value", "bucket",
                          mode="overwrite")
        for n in ids:
            delete_path(spark, f"{root}/batches/batch={n}")


def read_stream_archive(spark: SparkSession, archive: str) -> DataFrame:
    """All lines of a stream's archive (``value, bucket``): the merged segments and the batches after them."""
    root = archive.rstrip("/")
    segments = _archive_segments(spark, root)
    ids = [n for n in numbered_folders(spark, f"{root}/batches", "batch") if n > max(segments, default=-1)]
    parts = []
    if segments:
        schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("upto", T.LongType()),
                               T.StructField("bucket", T.StringType())])
        parts.append(spark.read.schema(schema).option("basePath", f"{root}/merged")
                     .text([f"{root}/merged/upto={n}" for n in segments]).select("value", "bucket"))
    if ids:
        parts.append(_archive_batches(spark, root, ids))
    if not parts:
        return spark.createDataFrame([], "value string, bucket string")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Read an archive back; the bucket is a string partition column (no type guessing)."""
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("bucket", T.StringType())])
    return spark.read.schema(schema).text(path)


def to_topic_records(routed: DataFrame, route_col: str = "route", value_col: str = "json",
                     topics: dict[str, str] | None = None, key_col: str | None = None) -> DataFrame:
    """Rows -> ``(topic, key, value)`` records for one Kafka write with a ``topic`` column."""
    topic = F.col(route_col)
    if topics:
        m = F.create_map(*[x for kv in topics.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
        topic = m[F.col(route_col)]
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return routed.select(topic.alias("topic"), key.alias("key"), F.col(value_col).cast("string").alias("value"))


def write_changes(changes: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch of keyed changes to ``path/batch_id=N`` (overwrite: replay-safe)."""
    changes.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def kv_table(changes: DataFrame, keys=("board_key", "event_type"), value: str = "value",
             order: str | tuple[str, ...] = "seq") -> DataFrame:
    """Current table of a keyed upsert log: per key, the last written value by ``order`` (one or more columns)."""
    return latest_per_key(changes, list(keys), value, order)
