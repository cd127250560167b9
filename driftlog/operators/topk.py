"""Top rows per group, and heavy hitters.

``top_k`` keeps ``k`` rows of each part of a group before the rows of a group
meet, so a hot group is never sorted in one task.  ``heavy_hitters`` finds
candidates with Misra-Gries summaries, one of bounded size per task, and counts
the candidates exactly in a second pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = 32


def top_k(df: DataFrame, group: tuple[str, ...], order: list[Column], k: int, parts: int = PARTS, rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group by ``order`` (which should break all ties), with their rank from 1.

    Each group is cut into ``parts`` by a hash of its rows; the first rows of each
    part are found (Spark keeps ``k`` per task and part before the shuffle), then
    those of the group among at most ``k * parts``.
    """
    spread = df.withColumn("_part", F.pmod(F.xxhash64(*[c for c in df.columns if df.schema[c].dataType.typeName() != "map"]), F.lit(parts)))
    within = Window.partitionBy(*group, "_part").orderBy(*order)
    some = spread.withColumn("_rank", F.row_number().over(within)).where(F.col("_rank") <= k).drop("_rank", "_part")
    return some.withColumn(rank_col, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank_col) <= k)


def misra_gries(counts: dict, more: list[tuple], size: int) -> dict:
    """Merge counted items into a summary of at most ``size`` counters.

    If there are more, all lose the ``size + 1``-th largest count; what is left of
    none goes.  An item of over ``1 / (size + 1)`` of all rows so far keeps a counter.
    """
    for item, n in more:
        counts[item] = counts.get(item, 0) + n
    if len(counts) <= size:
        return counts
    cut = sorted(counts.values(), reverse=True)[size]
    return {item: n - cut for item, n in counts.items() if n > cut}


def heavy_candidates(df: DataFrame, key: str, share: float) -> DataFrame:
    """``key``: every value that can hold over ``share`` of the rows (and some that don't); at most ``1 / share`` per task.

    A value over the share of all rows is over it in some task, and that task's summary keeps it.
    """
    size = int(1 / share)

    def summarise(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        counts: dict = {}
        for batch in batches:
            found = pc.value_counts(batch.column(0))
            counts = misra_gries(counts, zip(found.field(0).to_pylist(), found.field(1).to_pylist()), size)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), kind)], [key])

    import pyspark.sql.pandas.types as arrow_types
    kind = arrow_types.to_arrow_type(df.schema[key].dataType)
    return df.select(key).mapInArrow(summarise, df.select(key).schema).distinct()


def heavy_hitters(df: DataFrame, key: str, share: float) -> DataFrame:
    """``key, n`` of the values that hold over ``share`` of all rows, counted exactly (null is a value)."""
    if not 0 < share < 1:
        raise ValueError("share must be between 0 and 1")
    candidates = heavy_candidates(df, key, share).withColumnRenamed(key, "_key")
    counted = df.select(key).join(candidates, F.col(key).eqNullSafe(F.col("_key")), "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counted.where(F.col("n") > F.lit(share) * total)
