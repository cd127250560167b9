"""Command-line entry for the streaming jobs.

    spark-submit --py-files driftlog.zip driftlog/streaming/cli.py <job> \\
        --topics t1,t2 --restart_count 3 --bootstrap.servers host:9092 --output <dir> [--ck_time 5000] [...]

Jobs: ``enrich`` (P1), ``scoreboard`` (P2), ``active-users`` (distinct users
of P2's rows), ``split-archive`` (P3).

Dimensions: ``--places <parquet dir>`` (default: none known); the event
dictionary either as
``--dict_url/--dict_table[/--dict_user/--dict_password/--dict_driver]`` (JDBC) or
``--dictionary <parquet dir>``.  It is polled by every micro-batch for rows past
the last bound (``--dict_form dictionary|event_table`` chooses the first one,
``--dict_inclusive true`` reads the bound's own rows again).
``--on_missing null|drop|error`` decides about unknown event ids.

``--resolver module:function`` resolves unknown cells in ``enrich`` and
``split-archive``: the function takes the session and returns a resolver (see
``operators.places.geocoder_resolver``).  ``--sink console`` makes ``enrich``
print its rows.  ``--per_row true`` gives ``scoreboard`` per-row counts, for
topics without keys.  ``--compact_every N`` merges the archive every N batches,
``--roll_ms N`` whenever its oldest batch is N milliseconds old.

``--source files --input <dir>`` reads files instead of Kafka (columns
``seq`` and ``line`` or ``payload``); ``--once true`` processes what is
there and stops.  ``--max_offsets_per_trigger N`` bounds a micro-batch (and so
every state group) on Kafka; ``--min_partitions N`` splits Kafka partitions
into more tasks without a shuffle.
"""

from __future__ import annotations

import importlib
import sys

from pyspark.sql import DataFrame, SparkSession

from driftlog.operators import decode, dictionary
from driftlog.session import STREAM_CONF, build_session
from driftlog.sources import dictionary as dict_source
from driftlog.sources import kafka
from driftlog.streaming import control, jobs

JOBS = ("enrich", "scoreboard", "active-users", "split-archive")


def _dictionary_loader(spark: SparkSession, opts: dict[str, str]):
    if "dict_url" in opts:
        jdbc = dict_source.jdbc_options(opts["dict_url"], opts.get("dict_table", "tb_event_name"),
                                        opts.get("dict_user"), opts.get("dict_password"),
                                        opts.get("dict_driver"))
        return lambda: dict_source.jdbc_table(spark, jdbc)
    if "dictionary" in opts:
        return lambda: spark.read.parquet(opts["dictionary"])
    raise ValueError("give --dict_url/--dict_table or --dictionary")


def _source(spark: SparkSession, opts: dict[str, str], binary: bool) -> DataFrame:
    if opts.get("source", "kafka") == "files":
        col = "payload binary" if binary else "line string"
        reader = spark.readStream.schema(f"seq long, {col}")
        if "maxFilesPerTrigger" in opts:
            reader = reader.option("maxFilesPerTrigger", opts["maxFilesPerTrigger"])
        return reader.parquet(opts["input"])
    raw = kafka.read_stream(spark, kafka.source_options(
        opts, min_partitions=int(opts["min_partitions"]) if "min_partitions" in opts else None,
        max_offsets_per_trigger=int(opts["max_offsets_per_trigger"]) if "max_offsets_per_trigger" in opts
        else None))
    return kafka.value_bytes(raw) if binary else kafka.value_text(raw)


def _resolver(spark: SparkSession, opts: dict[str, str]):
    if "resolver" not in opts:
        return None
    module, _, function = opts["resolver"].partition(":")
    if not function:
        raise ValueError("give --resolver as module:function")
    return getattr(importlib.import_module(module), function)(spark)


def _names(spark: SparkSession, opts: dict[str, str], out: str) -> dict_source.IncrementalNames:
    form = opts.get("dict_form", "dictionary")
    if form not in dict_source.FIRST_BOUNDS:
        raise ValueError(f"--dict_form must be one of {', '.join(dict_source.FIRST_BOUNDS)}")
    return dict_source.IncrementalNames(spark, _dictionary_loader(spark, opts), f"{out}/names",
                                        first_bound=dict_source.FIRST_BOUNDS[form],
                                        inclusive=opts.get("dict_inclusive") == "true")


class _Pair:
    """Two queries, the second reading what the first writes, as one."""

    def __init__(self, spark: SparkSession, first, second, once: bool):
        self.spark, self.once = spark, once
        self.queries = [first()]
        if once:
            self.queries[0].awaitTermination()
        self.queries.append(second())

    def awaitTermination(self) -> None:  # noqa: N802  (the name that a query has)
        if self.once:
            self.queries[1].awaitTermination()
            return
        while all(q.isActive for q in self.queries):
            self.queries[1].awaitTermination(1)
        for q in self.queries:
            if q.exception() is not None:
                raise q.exception()
        self.stop()

    def stop(self) -> None:
        for q in self.queries:
            q.stop()


def build_query(spark: SparkSession, job: str, opts: dict[str, str]):
    """Return a zero-argument ``start()`` for ``job`` (used by the restart loop)."""
    if job not in JOBS:
        raise ValueError(f"job must be one of {JOBS}")
    ck = control.checkpoint_of(spark, opts, job)
    once = opts.get("once") == "true"
    trigger = {"availableNow": True} if once else control.trigger_of(opts)
    out = opts.get("output") or control.checkpoint_of(spark, {}, f"{job}-output")
    load_places = (lambda: spark.read.parquet(opts["places"])) if "places" in opts else None
    on_missing = opts.get("on_missing", "null")

    def start():
        if job == "enrich":
            return jobs.enrich_stream(_source(spark, opts, True), load_places, None, f"{out}/rows", ck,
                                      resolver=_resolver(spark, opts), place_output=f"{out}/places", trigger=trigger,
                                      sink=jobs.console_sink() if opts.get("sink") == "console" else None,
                                      incremental_names=_names(spark, opts, out), on_missing=on_missing)
        if job == "split-archive":
            kafka_opts = kafka.sink_options(opts) if opts.get("source", "kafka") == "kafka" else None
            return jobs.split_archive_stream(
                _source(spark, opts, False), load_places, f"{out}/routes", f"{out}/archive", ck, kafka_opts=kafka_opts,
                resolver=_resolver(spark, opts), place_output=f"{out}/places", trigger=trigger,
                compact_every=int(opts["compact_every"]) if "compact_every" in opts else None,
                roll_ms=int(opts["roll_ms"]) if "roll_ms" in opts else None)
        lines = _source(spark, opts, False)
        if opts.get("per_row") == "true" or job == "active-users":
            names = dictionary.latest_names(_dictionary_loader(spark, opts)())
            if job == "scoreboard":
                return jobs.scoreboard_rows_stream(lines, names, f"{out}/changes", ck, trigger=trigger,
                                                   on_missing=on_missing)
            named = dictionary.lookup_event_names(decode.parse_csv_events(lines), names, on_missing=on_missing)
            return jobs.active_users_stream(jobs._keyed(named), f"{out}/users", ck, trigger=trigger)
        seq_type = lines.schema["seq"].dataType.simpleString()
        names = _names(spark, opts, out)
        return _Pair(spark,
                     lambda: jobs.named_stream(lines, names.refresh, f"{out}/named", f"{ck}/named", trigger=trigger,
                                               on_missing=on_missing),
                     lambda: jobs.counted_stream(spark, f"{out}/named", f"{out}/changes", f"{ck}/counted", seq_type,
                                                 trigger=trigger), once)

    return start


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    if not argv or argv[0] not in JOBS:
        print(__doc__)
        return 2
    job, opts = argv[0], control.parse_job_args(argv[1:], required=("restart_count",))
    if opts.get("source", "kafka") == "kafka" and "topics" not in opts:
        raise ValueError("option --topics is required for the Kafka source")
    spark = spark or build_session(f"driftlog-{job}", extra=STREAM_CONF)
    start = build_query(spark, job, opts)
    return control.run_with_restarts(start, int(opts["restart_count"]))


if __name__ == "__main__":
    sys.exit(main())
