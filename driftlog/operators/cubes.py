"""Grouping sets, rollup and cube of views and distinct users.

Facts are read once and reduced to one row per (dimensions, user) with a count (a
hash aggregation with a map-side part).  Each level then starts from the reduced
rows of the smallest finer level: it drops a dimension, merges equal users, and
counts.  So the facts are never expanded, and distinct users are exact at every
level although they don't add up.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.operators.joins import stage_table


def cube_sets(dims: tuple[str, ...]) -> list[tuple[str, ...]]:
    """All subsets of the dimensions, finest first."""
    return [s for k in range(len(dims), -1, -1) for s in combinations(dims, k)]


def rollup_sets(dims: tuple[str, ...]) -> list[tuple[str, ...]]:
    """The dimensions, less the last, less the last two, and so on."""
    return [dims[:k] for k in range(len(dims), -1, -1)]


def grouping_sets(df: DataFrame, dims: tuple[str, ...], sets: list[tuple[str, ...]], user: str = "uid") -> DataFrame:
    """``dims, grouping_id, pv, uv`` of every set of dimensions.

    A dimension that a row's set leaves out is null and its bit of ``grouping_id``
    set (the first dimension's bit is the highest), which tells it from a null
    value.  ``pv`` counts rows, ``uv`` distinct non-null users.  The total of an
    empty table is one row of zeros, as in SQL.
    """
    per_user = stage_table(df.groupBy(*dims, user).agg(F.count(F.lit(1)).alias("_n")), "cube")
    made: dict[tuple[str, ...], DataFrame] = {tuple(dims): per_user}
    out = None
    for some in sorted({tuple(d for d in dims if d in s) for s in sets}, key=lambda s: (-len(s), s)):
        if some not in made:
            finer = min((f for f in made if set(some) < set(f)), key=len)
            made[some] = made[finer].groupBy(*some, user).agg(F.sum("_n").alias("_n"))
        rolled = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in some)
        level = made[some].groupBy(*some).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("pv"), F.count(user).alias("uv"))
        level = level.select(*[F.col(d) if d in some else F.lit(None).cast(df.schema[d].dataType).alias(d) for d in dims],
                             F.lit(rolled).cast("long").alias("grouping_id"), "pv", "uv")
        out = level if out is None else out.unionByName(level)
    return out
