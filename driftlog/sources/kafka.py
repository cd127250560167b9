"""Kafka source and sink options (batch and streaming).

The spark-sql-kafka package must be on the classpath for these readers to
load; option building is plain Python and usable without it.  Offsets are
kept in the streaming checkpoint, so a restarted query resumes where the
last committed micro-batch ended (``startingOffsets`` only applies to a
fresh checkpoint).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Job options that are not Kafka client properties.
_JOB_KEYS = {"topics", "ck_time", "restart_count", "checkpoint", "output", "group.id",
             "min_partitions", "max_offsets_per_trigger"}

# Client properties that Spark's Kafka source and sink refuse ...
_REFUSED = {"auto.offset.reset", "key.deserializer", "value.deserializer", "key.serializer",
            "value.serializer", "enable.auto.commit", "interceptor.classes"}
# ... and those that only a consumer knows.
_CONSUMER_ONLY = {"group.id", "auto.commit.interval.ms", "fetch.min.bytes", "fetch.max.bytes", "fetch.max.wait.ms",
                  "max.partition.fetch.bytes", "max.poll.records", "max.poll.interval.ms", "session.timeout.ms",
                  "heartbeat.interval.ms", "isolation.level", "partition.assignment.strategy"}


def _client_properties(job_opts: dict[str, str], without: set[str]) -> dict[str, str]:
    out = {}
    for k, v in job_opts.items():
        name = k.removeprefix("kafka.")
        if k not in _JOB_KEYS and "." in k and name not in without:
            out[f"kafka.{name}"] = v
    return out


def source_options(job_opts: dict[str, str], starting_offsets: str | None = None,
                   min_partitions: int | None = None,
                   max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Spark Kafka source options from ``--key value`` job options.

    ``topics`` (comma separated, required) becomes ``subscribe``; every other
    option that looks like a client property is forwarded as ``kafka.<key>``,
    but for those that Spark refuses.  ``auto.offset.reset`` becomes
    ``startingOffsets`` (default earliest); auto-commit stays off: progress
    lives in the checkpoint.
    """
    topics = job_opts.get("topics")
    if not topics:
        raise ValueError("option 'topics' is required (comma-separated topic names)")
    reset = job_opts.get("auto.offset.reset", job_opts.get("kafka.auto.offset.reset"))
    opts = {"subscribe": ",".join(t.strip() for t in topics.split(",") if t.strip()),
            "startingOffsets": starting_offsets or (reset if reset in ("earliest", "latest") else "earliest"),
            "failOnDataLoss": job_opts.get("failOnDataLoss", "true")}
    opts |= _client_properties(job_opts, _REFUSED)
    if "group.id" in job_opts:
        opts["kafka.group.id"] = job_opts["group.id"]
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def sink_options(job_opts: dict[str, str]) -> dict[str, str]:
    """Kafka sink options (client properties only; topic comes from a column)."""
    return _client_properties(job_opts, _REFUSED | _CONSUMER_ONLY)


def read_stream(spark: SparkSession, opts: dict[str, str]) -> DataFrame:
    """Streaming Kafka DataFrame: key, value (binary), topic, partition, offset, timestamp."""
    return spark.readStream.format("kafka").options(**opts).load()


def read_batch(spark: SparkSession, opts: dict[str, str]) -> DataFrame:
    o = dict(opts)
    o.setdefault("endingOffsets", "latest")
    return spark.read.format("kafka").options(**o).load()


def arrival_order() -> Column:
    """Total arrival order of Kafka records as one number: timestamp (ms), partition, offset.

    A 38-digit decimal with five digits for the partition and sixteen for the
    offset: it sorts, compares and aggregates like any number, in Python too.
    """
    digits = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.concat(digits(F.unix_millis(F.col("timestamp").cast("timestamp")), 13), digits(F.col("partition"), 5),
                    digits(F.col("offset"), 16)).cast("decimal(38,0)")


def value_text(df: DataFrame, out_col: str = "line") -> DataFrame:
    """UTF-8 text of the record value plus an arrival-order ``seq``."""
    return df.select(arrival_order().alias("seq"), F.col("value").cast("string").alias(out_col))


def value_bytes(df: DataFrame, out_col: str = "payload") -> DataFrame:
    return df.select(arrival_order().alias("seq"), F.col("value").alias(out_col))
