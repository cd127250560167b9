"""Dimension lookups and staged tables.

A lookup is a plain join on the key: Spark broadcasts a side by its bytes
(known before, or measured by AQE at run time) and otherwise shuffles both,
where AQE splits skewed partitions (one hot key can hold a large share of the
facts).  No hint is forced, and building a plan starts no job.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame

from driftlog.session import delete_path, shared_path


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    For facts that are expensive to derive (parsed text, decoded batches) and
    read twice: later passes scan the columnar copy and prune to the columns
    they need, instead of parsing the input again.
    """
    path = shared_path(df.sparkSession, "stage", name, unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged_for(df: DataFrame, name: str):
    """``stage_table`` for the length of a ``with`` block; the copy is deleted at its end."""
    path = shared_path(df.sparkSession, "stage", name, unique=True)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete_path(df.sparkSession, path)


def lookup_join(facts: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Many-to-one join of facts with a dimension (dimension keys must be unique)."""
    return facts.join(dim, on, how)
