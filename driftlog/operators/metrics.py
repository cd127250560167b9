"""Activity metrics: running per-user counts, page views, active users, scoreboard.

All keyed work is expressed as ``groupBy`` with partial (map-side)
aggregation, so a hot key -- one user or one activity holding a large share
of all rows -- is combined before the shuffle instead of landing whole on
one task.  The one per-row result (the running count) is computed in
bounded blocks of the order column, see ``running_count``.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Rows of one key inside one block of ``seq`` values are numbered by a window
# task; a block therefore holds at most this many rows of any key.
DEFAULT_SEQ_BLOCK = 1 << 20

USER_KEY = ("event_name", "event_type", "uid")
CELL_KEY = ("event_name", "first_dt", "event_type")


def running_count(df: DataFrame, keys: tuple[str, ...] = USER_KEY, seq: str = "seq",
                  carry_first: str | None = "dt", first_alias: str = "first_dt",
                  out_col: str = "cnt", seq_block: int = DEFAULT_SEQ_BLOCK) -> DataFrame:
    """Per-row running count of each key in ``seq`` order (a keyed running sum of 1s).

    Also attaches the value of ``carry_first`` from the key's first row (the
    fields a keyed running sum keeps from the first record).

    Skew-safe plan: rows are split into blocks ``seq div seq_block``; per
    (key, block) we aggregate a row count and the block's first value
    (partial aggregation), prefix-sum the block counts per key over the small
    aggregated table, then number rows inside each (key, block) -- a window
    whose partition holds at most ``seq_block`` rows however hot the key is.
    Null keys are keys like any other (an unknown type is null), so the
    blocks are joined null-safely.
    """
    if not isinstance(df.schema[seq].dataType, NumericType):
        raise TypeError(f"running_count needs a numeric order column; {seq!r} is "
                        f"{df.schema[seq].dataType.simpleString()} (for Kafka records use the offset "
                        "of a single partition or a numeric arrival id)")
    k = list(keys)
    blocked = df.withColumn("_blk", F.floor(F.col(seq) / F.lit(seq_block)).cast("long"))
    # Facts meet only counts and numeric minima (a hash aggregation); the text
    # that goes with the minimum is picked from the few rows left.
    carried = [carry_first] if carry_first else []
    per_value = blocked.groupBy(*k, "_blk", *carried).agg(F.count(F.lit(1)).alias("_n"), F.min(seq).alias("_first_seq"))
    per_block = per_value.groupBy(*k, "_blk").agg(
        F.sum("_n").alias("_n"), *[F.min_by(c, "_first_seq").alias("_first_b") for c in carried])
    by_key = Window.partitionBy(*k).orderBy("_blk")
    offsets = per_block.select(
        *k, "_blk",
        F.coalesce(F.sum("_n").over(by_key.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        *([F.first("_first_b").over(by_key.rowsBetween(Window.unboundedPreceding, 0))
           .alias(first_alias)] if carry_first else []),
    )
    in_block = Window.partitionBy(*k, "_blk").orderBy(seq)
    renamed = offsets.select(*[F.col(c).alias(f"_k_{c}") for c in [*k, "_blk"]],
                             *[c for c in offsets.columns if c not in (*k, "_blk")])
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*k, "_blk"]]
    joined = blocked.join(renamed, reduce(and_, same), "inner")
    return (joined.withColumn(out_col, (F.col("_off") + F.row_number().over(in_block)).cast("long"))
            .drop("_blk", "_off", *[f"_k_{c}" for c in [*k, "_blk"]]))


def page_views(df: DataFrame, keys: tuple[str, ...] = USER_KEY, out_col: str = "pv") -> DataFrame:
    """Final value of the running count: events per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out_col))


def active_users(df: DataFrame, keys: tuple[str, ...] = ("event_name", "dt", "event_type"),
                 user: str = "uid", out_col: str = "uv", approx: bool = False) -> DataFrame:
    """Distinct users per activity, day and type (what the job's name promises)."""
    agg = F.approx_count_distinct(user) if approx else F.count_distinct(F.col(user))
    return df.groupBy(*keys).agg(agg.alias(out_col))


def key_summary(df: DataFrame, keys: tuple[str, ...] = USER_KEY, seq: str = "seq",
                dt: str = "dt") -> DataFrame:
    """Per key: running count's final value, first-seen date, last seq.

    Two steps: facts are counted per key and date with numeric minima and
    maxima (a hash aggregation), then the date of the least seq is picked.
    """
    per_day = df.groupBy(*keys, dt).agg(F.count(F.lit(1)).alias("_n"), F.min(seq).alias("_first"),
                                        F.max(seq).alias("_last"))
    return per_day.groupBy(*keys).agg(
        F.sum("_n").alias("cnt"),
        F.min_by(dt, "_first").alias("first_dt"),
        F.max("_last").alias("last_seq"),
    )


def arrival_summary(df: DataFrame, arrival: Column, keys: tuple[str, ...] = USER_KEY,
                    dt: str = "dt") -> DataFrame:
    """Streaming form of ``key_summary``: first date and last row by ``arrival``.

    One aggregation step, because a stream in update mode allows only one.
    ``arrival`` is a sortable value, e.g. a struct of batch time and order.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min_by(dt, arrival).alias("first_dt"),
        F.max(arrival).alias("last"),
    )


def scoreboard_from_summary(summary: DataFrame, name: str = "event_name",
                            type_col: str = "event_type", last: str = "last_seq") -> DataFrame:
    """Cell ``name|first_dt`` x type -> count of the key written last into it."""
    cell = summary.groupBy(name, "first_dt", type_col).agg(
        F.max_by("cnt", last).alias("_v"))
    return cell.select(F.concat_ws("|", F.col(name), F.col("first_dt")).alias("board_key"),
                       F.col(type_col).alias("event_type"),
                       F.col("_v").cast("string").alias("value"))


def activity_scoreboard(df: DataFrame, seq: str = "seq", dt: str = "dt") -> DataFrame:
    """The scoreboard a per-row keyed running count writes into a keyed store.

    Each row writes its key's running count into cell
    (``event_name|first-seen date``, ``event_type``); the last write wins.
    All rows of a key share one first-seen date and so one cell, hence the
    cell's last writer is the key with the greatest last seq, and its value
    is that key's total.
    """
    return scoreboard_from_summary(key_summary(df, seq=seq, dt=dt))


def latest_per_key(df: DataFrame, keys: list[str] | tuple[str, ...], value: str,
                   order: str | tuple[str, ...], out_col: str = "value") -> DataFrame:
    """Keyed upsert table: per key, the value of the last write by ``order`` (one or more columns).

    Of several writes that are last by ``order`` the greatest value counts; a key
    may be null, and so may a value or an order (before all others).  The greatest
    order of a key is a number, so facts meet a hash aggregation and one row per
    key is shuffled, whatever the values are; the facts are then joined with those
    few.  With several order columns writes are first reduced per key, leading
    columns and value.
    """
    if not isinstance(order, tuple):
        last = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.max(order).alias("_last"))
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col(order).eqNullSafe(F.col("_last"))]
        # a set of the values that are last (one, but for equal orders): text has no maximum in a hash aggregation
        return df.join(last, reduce(and_, same), "left_semi").groupBy(*keys).agg(F.array_max(F.collect_set(value)).alias(out_col))
    first, last = order[:-1], order[-1]
    per_value = df.groupBy(*keys, *first, F.col(value).alias("_value")).agg(F.max(last).alias("_last"))
    by = F.struct(*first, "_last") if first else F.col("_last")
    return per_value.groupBy(*keys).agg(F.max_by("_value", by).alias(out_col))
