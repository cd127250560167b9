"""Mergeable distinct-user sketches: stored per day, rolled up without the raw rows.

A sketch is a binary column of fixed size (at most ``2 ** lg_k`` bytes and a
little), so the stored table grows with days and activities, not with users, and
any coarser period is a union of its sketches.  The relative standard error of an
estimate is about ``1.04 / sqrt(2 ** lg_k)``: 0.8 percent at the default.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / math.sqrt(1 << lg_k)


def user_sketches(df: DataFrame, keys: tuple[str, ...] = ("event_name", "dt"), user: str = "uid", lg_k: int = LG_K) -> DataFrame:
    """``keys, sketch, n_events``: a HyperLogLog sketch of the users of each key (null users are not counted)."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(user, F.lit(lg_k)).alias("sketch"), F.count(F.lit(1)).alias("n_events"))


def roll_up(sketches: DataFrame, keys: list[Column] | tuple[str, ...]) -> DataFrame:
    """Sketches of a coarser key: ``keys, sketch, n_events``."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("n_events").alias("n_events"))


def estimate(sketch: str | Column = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)
