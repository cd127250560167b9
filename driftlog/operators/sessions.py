"""Session windows: a key's rows with no gap above a bound between neighbours.

Batch: rows are first aggregated per key and time bin as wide as the gap; rows of
one bin are always of one session, so facts meet a hash aggregation only.  The
session bounds are then found over these bins, at most one row per key and gap
length, and the bins summed up.  Streams: ``session_window`` merges state
(``streaming.windows.sessions_stream``) with the same rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftlog.functions.clock import bin_of, micros


def sessionize(df: DataFrame, keys: tuple[str, ...], time: str, gap: int) -> DataFrame:
    """``keys, session_start, session_end, n_events``: times of the first and last row, in microseconds.

    Two neighbours are of one session if they are at most ``gap`` microseconds
    apart (units of a numeric time).  Rows without a time are in none; a null key
    is a key like any other.
    """
    at = micros(F.col(time), df.schema[time].dataType)
    rows = df.select(*keys, at.alias("_at")).where("_at IS NOT NULL")
    bins = rows.groupBy(*keys, bin_of(F.col("_at"), gap).alias("_bin")).agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count(F.lit(1)).alias("_n"))
    by_key = Window.partitionBy(*keys).orderBy("_bin")
    begins = F.coalesce((F.col("_first") - F.lag("_last").over(by_key) > gap).cast("int"), F.lit(1))
    numbered = bins.withColumn("_begins", begins).withColumn("_session", F.sum("_begins").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_session").agg(
        F.min("_first").alias("session_start"), F.max("_last").alias("session_end"), F.sum("_n").alias("n_events")).drop("_session")
