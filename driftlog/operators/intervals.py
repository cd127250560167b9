"""Interval join: pairs of rows of one key whose times lie within bounds of each other.

Times are cut into bins as wide as the bounds.  A right row is in one bin; a left
row meets the one or two bins that its interval touches.  So a range join becomes
an equi-join on (key, bin) with a check of the times, and each pair meets once.
A hot (key, bin) is split: its right rows are dealt into parts of bounded size,
and its left rows, one copy for each part, meet them in as many tasks.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.functions.clock import bin_of, micros

#: Right rows of one (key, bin) that a task meets.
HOT_ROWS = 1 << 18


def interval_join(left: DataFrame, right: DataFrame, keys: tuple[str, ...], left_time: str, right_time: str,
                  lower: int, upper: int, hot_rows: int = HOT_ROWS, gap_col: str = "gap") -> DataFrame:
    """Pairs of equal ``keys`` with ``lower <= right_time - left_time <= upper`` (microseconds, or units of a numeric time).

    Gives the keys, the other columns of both sides (their names must differ) and
    the difference in ``gap_col``.  Null keys and times meet nothing; repeated rows
    meet each; ``lower`` may be negative.
    """
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    if lower > upper:
        raise ValueError("lower is above upper")
    width = max(1, upper - lower)
    lefts = left.withColumn("_lt", micros(F.col(left_time), left.schema[left_time].dataType)).where("_lt IS NOT NULL")
    rights = right.withColumn("_rt", micros(F.col(right_time), right.schema[right_time].dataType)).where("_rt IS NOT NULL")
    rights = rights.withColumn("_bin", bin_of(F.col("_rt"), width))
    first, last = bin_of(F.col("_lt") + F.lit(lower), width), bin_of(F.col("_lt") + F.lit(upper), width)
    lefts = lefts.withColumn("_bin", F.explode(F.sequence(first, last)))

    hot = rights.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    hot = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.col("_bin").alias("_h_bin"),
                     F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_parts"))
    is_hot = reduce(and_, [F.col(k) == F.col(f"_h_{k}") for k in keys] + [F.col("_bin") == F.col("_h_bin")])
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    lefts = lefts.join(hot, is_hot, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    lefts = lefts.select(*left.columns, "_lt", "_bin", "_part")
    dealt = F.pmod(F.xxhash64(*[c for c in right.columns if right.schema[c].dataType.typeName() != "map"]), parts.cast("long")).cast("int")
    rights = rights.join(hot, is_hot, "left").withColumn("_part", dealt).select(*right.columns, "_rt", "_bin", "_part")

    renamed = rights.select(*[F.col(c).alias(f"_r_{c}") if c in (*keys, "_bin", "_part") else F.col(c) for c in rights.columns])
    same = [F.col(c) == F.col(f"_r_{c}") for c in (*keys, "_bin", "_part")]
    gap = F.col("_rt") - F.col("_lt")
    met = lefts.join(renamed, reduce(and_, same) & gap.between(lower, upper))
    others = [c for c in (*left.columns, *right.columns) if c not in keys]
    return met.select(*keys, *others, gap.alias(gap_col))
