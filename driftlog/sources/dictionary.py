"""Event dictionary source: a database table polled by ``last_update``.

``jdbc_table`` returns a lazy DataFrame; filters on it (the poll bound) are
pushed into the database query by Spark's JDBC source.  ``IncrementalNames``
keeps the resolved dictionary in versioned folders of the shared storage; the
newest version holds the high-water mark too, so a restarted job goes on from
the last bound instead of reading all again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlog.operators.dictionary import incremental_poll
from driftlog.session import delete_path, numbered_folders

# First lower bounds of the two dictionary forms.
FIRST_BOUND = "2000-09-02 17:09:59"
FIRST_BOUND_EVENT_TABLE = "1999-09-01 22:36:30"
FIRST_BOUNDS = {"dictionary": FIRST_BOUND, "event_table": FIRST_BOUND_EVENT_TABLE}


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetch_size: int = 1000) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``; credentials come from the caller only."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    return opts


def jdbc_table(spark: SparkSession, opts: dict[str, str],
               columns=("event_id", "event_name", "last_update")) -> DataFrame:
    """The dictionary table with its columns as text (``last_update`` compares as text)."""
    df = spark.read.format("jdbc").options(**opts).load()
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns])


class DictionaryPoller:
    """Incremental reads of a dictionary table by a ``last_update`` bound, for one process.

    ``load`` is any zero-argument callable returning the dictionary
    DataFrame (JDBC, Parquet, Delta ...).  ``inclusive`` mode compares with
    ``>=``: rows sharing the bound's timestamp that commit late are not lost, and
    the rows re-read with them are harmless because applying a dictionary row is
    an idempotent upsert.  The bound that outlives the process is kept by
    ``IncrementalNames``.
    """

    def __init__(self, load, first_bound: str = FIRST_BOUND, inclusive: bool = False):
        self.load, self.inclusive, self.bound = load, inclusive, first_bound

    def poll(self) -> DataFrame:
        """Rows newer than the bound; advances the bound to their max ``last_update``."""
        rows = incremental_poll(self.load(), self.bound, inclusive=self.inclusive)
        # A single scalar comes back to the driver: the new high-water mark.
        top = rows.agg(F.max("last_update").alias("m")).first()["m"]
        if top is not None and top > self.bound:
            self.bound = top
        return rows


class IncrementalNames:
    """Resolved event dictionary kept up to date by incremental polls.

    ``refresh(version)`` starts from the newest complete version before
    ``version`` in ``store`` -- written by whichever process -- polls only the
    rows past its bound (the filter reaches the database), merges them, newest
    ``last_update`` per id winning, and writes ``store/version=<version>``.  Table
    and bound are one thing: the bound is the table's greatest ``last_update``.
    So a failure at any point re-polls the same rows, a replayed version is
    rebuilt from the version before it, and a new process finds the last state.
    Use it inside ``foreachBatch`` with the micro-batch id as version.  Only the
    last ``keep`` versions stay.
    """

    def __init__(self, spark: SparkSession, load, store: str, first_bound: str = FIRST_BOUND,
                 inclusive: bool = False, keep: int = 3):
        self.spark, self.load, self.store = spark, load, store.rstrip("/")
        self.first_bound, self.inclusive, self.keep = first_bound, inclusive, max(2, keep)

    def _path(self, version: int) -> str:
        return f"{self.store}/version={version}"

    def refresh(self, version: int) -> DataFrame:
        """``event_id, event_name, last_update``: the dictionary as of this version."""
        done = [v for v in numbered_folders(self.spark, self.store, "version") if v < version]
        held = self.spark.read.parquet(self._path(done[-1])) if done else None
        bound = held.agg(F.max("last_update")).first()[0] if held is not None else None
        new = incremental_poll(self.load(), bound, inclusive=self.inclusive, first_bound=self.first_bound)
        new = new.select("event_id", "event_name", "last_update")
        merged = new if held is None else held.unionByName(new)
        latest = merged.groupBy("event_id").agg(F.max_by("event_name", "last_update").alias("event_name"),
                                                F.max("last_update").alias("last_update"))
        latest.write.mode("overwrite").parquet(self._path(version))
        for old in done[:-(self.keep - 1)]:
            delete_path(self.spark, self._path(old))
        return self.spark.read.parquet(self._path(version))
