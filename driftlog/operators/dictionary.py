"""Event dictionary: resolving versions, polling increments, looking names up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.operators.joins import lookup_join


def latest_names(dictionary: DataFrame, key: str = "event_id", name: str = "event_name",
                 version: str = "last_update") -> DataFrame:
    """One row per id: the name with the newest version (last put wins)."""
    return dictionary.groupBy(key).agg(F.max_by(name, version).alias(name))


def poll_order_names(poll: DataFrame, key: str = "event_id", name: str = "event_name",
                     version: str = "last_update") -> DataFrame:
    """Literal replay of one newest-first poll: the oldest row of an id is put last and wins."""
    return poll.groupBy(key).agg(F.min_by(name, version).alias(name))


def resolve_polls(polls: DataFrame, poll_col: str = "poll_id", key: str = "event_id",
                  name: str = "event_name", version: str = "last_update",
                  order: str = "newest") -> DataFrame:
    """Dictionary state after a sequence of polls.

    ``order="newest"`` lets the newest version win everywhere; ``order="poll"``
    reproduces the put order of newest-first polls: inside a poll the oldest
    row of an id wins, across polls the later poll wins.
    """
    if order == "newest":
        return latest_names(polls, key, name, version)
    if order != "poll":
        raise ValueError("order must be 'newest' or 'poll'")
    within = polls.groupBy(poll_col, key).agg(F.min_by(name, version).alias(name))
    return within.groupBy(key).agg(F.max_by(name, poll_col).alias(name))


def incremental_poll(dictionary: DataFrame, bound: str | None,
                     version: str = "last_update", inclusive: bool = False,
                     first_bound: str = "2000-09-02 17:09:59") -> DataFrame:
    """Rows changed after ``bound`` (strict ``>`` unless ``inclusive``).

    On a JDBC or Parquet source the comparison is pushed down to the scan.
    The caller keeps the high-water mark: ``max(version)`` of the result
    (see ``driftlog.sources.dictionary``).
    """
    b = first_bound if bound is None else bound
    cond = F.col(version) >= F.lit(b) if inclusive else F.col(version) > F.lit(b)
    return dictionary.where(cond)


def lookup_event_names(facts: DataFrame, names: DataFrame, fact_key: str = "type_id",
                       key: str = "event_id", name: str = "event_name",
                       out_col: str = "event_type_name", on_missing: str = "null") -> DataFrame:
    """Add ``out_col`` to every fact by id; ``names`` must hold one row per id.

    On a streaming ``facts`` a JDBC-backed dictionary is re-read by every
    micro-batch; Spark chooses the join by the bytes it then has.

    ``on_missing``: ``"null"`` keeps the fact with a null name, ``"drop"``
    removes it, ``"error"`` fails the task (the reference's null dereference).
    """
    if on_missing not in ("null", "drop", "error"):
        raise ValueError("on_missing must be 'null', 'drop' or 'error'")
    dim = names.select(F.col(key).alias("_dict_key"), F.col(name).alias(out_col))
    how = "inner" if on_missing == "drop" else "left"
    joined = lookup_join(facts.withColumn("_dict_key", F.col(fact_key)), dim, "_dict_key", how).drop("_dict_key")
    if on_missing == "error":
        joined = joined.where(F.when(F.col(out_col).isNull(),
                                     F.raise_error(F.concat(F.lit("unknown event id "),
                                                            F.col(fact_key).cast("string")))).isNull())
    return joined
