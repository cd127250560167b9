"""As-of join: each fact gets the version of its key that was valid at its time.

The right side (versions) is cut into time bins per key.  A bin keeps its own
versions and the last one before it, carried on from bin to bin over the small
table of bins; bins without versions keep the carried one alone.  A fact then
meets the versions of its (key, bin) in a plain equi-join and picks the last one
not after it.  Facts are neither sorted nor windowed: Spark broadcasts the
versions if they are small (the facts aren't shuffled at all), else joins by
(key, bin), where a hot key is spread over its bins and AQE splits a hot bin.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlog.functions.clock import DAY, bin_of, micros


def _bins(df: DataFrame, time: str, width: int) -> Column:
    return bin_of(micros(F.col(time), df.schema[time].dataType), width)


def version_bins(right: DataFrame, keys: tuple[str, ...], time: str, values: tuple[str, ...], tie: tuple[str, ...],
                 width: int, last_bin: Column) -> DataFrame:
    """``keys, bin, versions``: what can be valid in each bin from a key's first version up to ``last_bin``.

    ``versions`` are structs of time, ``tie`` and ``values``: those of the bin, and
    the last one before it.  The window runs over one row per (key, bin) that has
    versions, never over the versions themselves.
    """
    known = right.where(reduce(and_, [F.col(c).isNotNull() for c in (*keys, time)]))
    version = F.struct(F.col(time).alias("t"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(tie)],
                       *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    filled = known.groupBy(*keys, _bins(known, time, width).alias("bin")).agg(
        F.collect_list(version).alias("own"), F.max(version).alias("last"))
    by_key = Window.partitionBy(*keys).orderBy("bin")
    carried = filled.withColumn("before", F.lag("last").over(by_key)).withColumn("next", F.lead("bin").over(by_key))
    until = F.greatest(F.col("bin"), F.coalesce(F.col("next") - 1, last_bin, F.col("bin")))
    spread = carried.select(*keys, "bin", "own", "before", "last", F.explode(F.sequence(F.col("bin"), until)).alias("at"))
    with_before = F.when(F.col("before").isNull(), F.col("own")).otherwise(F.concat(F.array("before"), F.col("own")))
    return spread.select(*keys, F.col("at").alias("bin"),
                         F.when(F.col("at") == F.col("bin"), with_before).otherwise(F.array("last")).alias("versions"))


def asof_join(left: DataFrame, right: DataFrame, keys: tuple[str, ...], left_time: str, right_time: str,
              values: tuple[str, ...], tie: tuple[str, ...] = (), width: int = DAY) -> DataFrame:
    """``left`` with the ``values`` of the last row of ``right`` of the same keys whose time isn't after the fact's.

    Every row of ``left`` is kept once; without such a version, or with a null key
    or time, the values are null.  Of versions of one key and time that with the
    greatest ``tie`` (then values) counts.  Versions with a null key or time are
    never valid.  ``width`` (microseconds, or units of a numeric time) bounds what a
    fact looks through: the versions of its key in one bin.  ``values`` must not
    be names of ``left``.
    """
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    latest = left.agg(F.max(_bins(left, left_time, width))).scalar()  # up to where the last versions are carried
    versions = version_bins(right, keys, right_time, values, tie, width, latest)
    versions = versions.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("bin").alias("_k_bin"), F.col("versions").alias("_versions"))
    same = [F.col(k) == F.col(f"_k_{k}") for k in keys] + [F.col("_bin") == F.col("_k_bin")]
    met = left.withColumn("_bin", _bins(left, left_time, width)).join(versions, reduce(and_, same), "left")
    valid = F.array_max(F.filter("_versions", lambda v: v["t"] <= F.col(left_time)))
    return met.withColumn("_valid", valid).select(*left.columns, *[F.col("_valid")[f"v{i}"].alias(c) for i, c in enumerate(values)])
