"""Event-time windows on streams: sessions, tumbling and sliding counts with late rows, repeats dropped.

``sessions_stream`` and ``first_copies_stream`` keep their state in Spark and
drop it behind the watermark.  ``WindowStore`` keeps counts in the shared folder,
one folder per micro-batch, together with the greatest event time so far; a row
whose window had ended before its batch by that clock is counted apart, never
lost.  All folders are overwritten as a whole when a batch is replayed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlog.functions.clock import event_time, micros
from driftlog.operators.windows import window_counts, windowed
from driftlog.session import numbered_folders


def _span(microseconds: int) -> str:
    return f"{microseconds} microseconds"


def sessions_stream(df: DataFrame, keys: tuple[str, ...], time: str, gap: int, delay: int) -> DataFrame:
    """Streaming form of ``operators.sessions.sessionize`` (append mode): a session leaves once the watermark has passed it.

    State is one row per open session of a key; rows later than ``delay``
    (microseconds) behind the greatest event time may be dropped by Spark.
    """
    rows = df.select(*keys, event_time(F.col(time), df.schema[time].dataType).alias("_at")).withWatermark("_at", _span(delay))
    found = rows.groupBy(*keys, F.session_window("_at", _span(gap))).agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count(F.lit(1)).alias("n_events"))
    return found.select(*keys, F.unix_micros("_first").alias("session_start"), F.unix_micros("_last").alias("session_end"), "n_events")


def first_copies_stream(df: DataFrame, keys: tuple[str, ...], time: str, delay: int) -> DataFrame:
    """Only the first copy of each key (such as topic, partition and offset) within the watermark.

    A replayed file or topic gives nothing new as long as its copies are less than
    ``delay`` microseconds of event time behind; a key's state is dropped after that.
    """
    rows = df.withColumn("_at", event_time(F.col(time), df.schema[time].dataType)).withWatermark("_at", _span(delay))
    return rows.dropDuplicatesWithinWatermark(list(keys)).select(*df.columns)


class WindowStore:
    """Counts per key and window of a stream, late rows apart, in folders of the shared storage.

    ``counts/batch_id=N`` holds what micro-batch N adds, ``marks/batch_id=N`` the
    greatest event time up to it; ``folded/upto=N`` is the sum of all batches up
    to N, so that folders don't pile up.
    """

    def __init__(self, spark: SparkSession, root: str, keys: tuple[str, ...], time: str, width: int, slide: int | None = None,
                 delay: int = 0) -> None:
        self.spark, self.root, self.keys, self.time = spark, root.rstrip("/"), tuple(keys), time
        self.width, self.slide, self.delay = width, slide or width, delay

    def _latest_before(self, batch_id: int) -> int | None:
        known = [n for n in numbered_folders(self.spark, f"{self.root}/marks", "batch_id") if n < batch_id]
        return self.spark.read.parquet(f"{self.root}/marks/batch_id={known[-1]}").first()["latest"] if known else None

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """The body of ``foreachBatch``; a replay writes the same again."""
        before = self._latest_before(batch_id)
        late = F.lit(False) if before is None else F.col("window_end") <= F.lit(before - self.delay)
        held = windowed(batch.select(*self.keys, self.time), self.time, self.width, self.slide)
        window_counts(held, self.keys, late).write.mode("overwrite").parquet(f"{self.root}/counts/batch_id={batch_id}")
        at = micros(F.col(self.time), batch.schema[self.time].dataType)
        latest = batch.agg(F.greatest(F.max(at), F.lit(before).cast("long")).alias("latest"))
        latest.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/marks/batch_id={batch_id}")

    def _parts(self, upto: int | None = None) -> tuple[list[DataFrame], int]:
        batches = [n for n in numbered_folders(self.spark, f"{self.root}/counts", "batch_id") if upto is None or n <= upto]
        folded = numbered_folders(self.spark, f"{self.root}/folded", "upto")
        since = folded[-1] if folded else -1
        paths = [f"{self.root}/counts/batch_id={n}" for n in batches if n > since]
        parts = [self.spark.read.parquet(*paths)] if paths else []
        return parts + ([self.spark.read.parquet(f"{self.root}/folded/upto={since}")] if folded else []), max([since, *batches])

    def _sum(self, parts: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, parts).groupBy(*self.keys, "window_start").agg(F.sum("n").alias("n"), F.sum("n_late").alias("n_late"))

    def table(self, closed_only: bool = False) -> DataFrame:
        """``keys, window_start, n, n_late`` of all batches so far; of closed windows only, if wanted."""
        parts, last = self._parts()
        out = self._sum(parts)
        if closed_only:
            latest = self._latest_before(last + 1)
            out = out.where(F.lit(latest is not None) & (F.col("window_start") + F.lit(self.width) <= F.lit((latest or 0) - self.delay)))
        return out

    def fold(self, upto: int | None = None) -> None:
        """Write the sum of all batches up to ``upto`` (default: all complete ones) as a new version."""
        parts, last = self._parts(upto)
        if len(parts) and last not in numbered_folders(self.spark, f"{self.root}/folded", "upto"):
            self._sum(parts).write.mode("overwrite").parquet(f"{self.root}/folded/upto={last}")


def windowed_counts_stream(df: DataFrame, store: WindowStore, checkpoint: str, trigger: dict | None = None):
    """Start counting a stream into ``store``."""
    return df.writeStream.foreachBatch(store.write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
