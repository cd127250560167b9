"""Tumbling and sliding windows over event time, with watermark and late rows.

``arrived`` gives each row the watermark that holds when it arrives: the greatest
event time of all earlier micro-batches, less a delay.  A row is late for a
window that ends at or before that watermark: the window's state is gone by then.
Late rows aren't lost, they are counted apart.  The streaming form
(``streaming.windows.windowed_counts_stream``) keeps the same rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlog.functions.clock import micros


def windows_of(clock: Column, width: int, slide: int) -> Column:
    """Starts of all windows of ``width`` that hold a time, one every ``slide`` (none in the gaps of a slide above the width)."""
    last = clock - F.pmod(clock, F.lit(slide))
    # the earliest start that is still above clock - width
    count = F.floor((F.lit(width - 1) - (clock - last)) / F.lit(slide)).cast("long")
    return F.when(count >= 0, F.sequence(last - count * F.lit(slide), last, F.lit(slide)))


def batch_watermarks(df: DataFrame, batch: str, time: str, delay: int) -> DataFrame:
    """``batch, watermark``: the greatest time of all earlier batches less ``delay`` (null: none yet).

    One row per micro-batch; the running maximum is over these rows.
    """
    at = micros(F.col(time), df.schema[time].dataType)
    latest = df.groupBy(batch).agg(F.max(at).alias("_latest"))
    earlier = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    return latest.select(batch, (F.max("_latest").over(earlier) - F.lit(delay)).alias("watermark"))


def windowed(df: DataFrame, time: str, width: int, slide: int | None = None) -> DataFrame:
    """A row per window of each row: ``window_start, window_end`` in microseconds.  Rows without a time have none."""
    at = micros(F.col(time), df.schema[time].dataType)
    held = df.withColumn("window_start", F.explode(windows_of(at, width, slide or width)))
    return held.withColumn("window_end", F.col("window_start") + F.lit(width))


def window_counts(df: DataFrame, keys: tuple[str, ...], late: Column) -> DataFrame:
    """``keys, window_start, n, n_late`` of rows with windows; ``late`` says which come too late for theirs."""
    is_late = F.coalesce(late, F.lit(False))
    return df.groupBy(*keys, "window_start").agg(F.count_if(~is_late).alias("n"), F.count_if(is_late).alias("n_late"))


def windowed_counts(df: DataFrame, keys: tuple[str, ...], time: str, width: int, slide: int | None = None,
                    batch: str | None = None, delay: int = 0) -> DataFrame:
    """Rows per key and window: ``keys, window_start, n, n_late``.

    ``width``, ``slide`` (default: ``width``, tumbling) and ``delay`` are in
    microseconds or units of a numeric time.  With ``batch``, the number of the
    micro-batch in which a row arrives, rows too late for a window are counted in
    ``n_late`` instead of ``n``; without it none is late.
    """
    held = windowed(df, time, width, slide)
    if batch is None:
        return window_counts(held, keys, F.lit(False))
    marks = batch_watermarks(df, batch, time, delay).withColumnRenamed(batch, "_batch")
    met = held.join(marks, F.col(batch) == F.col("_batch"), "left")
    return window_counts(met, keys, F.col("window_end") <= F.col("watermark"))
