"""Structured Streaming forms of the three jobs.

* ``enrich_stream``        -- protobuf batches -> flatten -> place + event name (P1)
* ``scoreboard_stream``    -- CSV lines -> event name -> running counts -> scoreboard (P2)
* ``split_archive_stream`` -- JSON lines -> place -> route to topics + hourly archive (P3)

Stateless jobs do their lookups inside ``foreachBatch`` and reload the
dimensions for every micro-batch, so dictionary changes are seen by the
next batch.  Every folder written is keyed by the micro-batch id and
overwritten on replay, so a restart from the checkpoint gives the same folders
(exactly once); records sent to Kafka topics are sent again by a replay (at
least once), keyed by their arrival order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftlog.functions.geohash import with_geohash
from driftlog.functions.text import date_part
from driftlog.operators import decode, dictionary, metrics, places, route, sinks
from driftlog.session import delete_path, make_folder, numbered_folders, publish_folder
from driftlog.sources.protobuf import decode_log_batches

Loader = Callable[[], DataFrame]


def _start(writer, checkpoint: str, trigger: dict | None, name: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


PLACE_SCHEMA = "geohash5 string, province string, city string, district string"


class PlaceStore:
    """The place dictionary of a stream: a base table and the cells the stream has resolved.

    Each micro-batch writes its *new* cells, once, to ``folder/batch_id=N``, and
    reads them back for its join, so the resolver is called once per cell and rows
    and dictionary agree.  A batch sees the base and the cells of the batches
    before it; a replayed batch resolves its own cells anew and replaces them.  A
    cell that several sources know has one place: the base's, else that of the
    earliest batch.  ``compact`` adds a version ``folder/merged/upto=N`` that holds
    all batches up to N.
    """

    def __init__(self, spark: SparkSession, folder: str, base: Loader | None = None):
        self.spark, self.folder, self.base = spark, folder.rstrip("/"), base

    def _resolved(self, before: int | None = None) -> DataFrame | None:
        """Cells resolved by the batches before ``before``, with the batch as ``source``."""
        merged = [n for n in numbered_folders(self.spark, f"{self.folder}/merged", "upto") if before is None or n < before]
        since = merged[-1] if merged else -1
        ids = [n for n in numbered_folders(self.spark, self.folder, "batch_id") if n > since and (before is None or n < before)]
        parts = []
        if merged:
            parts.append(self.spark.read.schema(f"{PLACE_SCHEMA}, source long").parquet(f"{self.folder}/merged/upto={since}"))
        if ids:
            rows = self.spark.read.schema(f"{PLACE_SCHEMA}, batch_id long").option("basePath", self.folder)
            parts.append(rows.parquet(*[f"{self.folder}/batch_id={n}" for n in ids]).withColumnRenamed("batch_id", "source"))
        return reduce(DataFrame.unionByName, parts) if parts else None

    @staticmethod
    def _first(cells: DataFrame) -> DataFrame:
        """Per cell the place of its least source."""
        place = F.struct("source", *places.PLACE_COLS)
        return cells.groupBy("geohash5").agg(F.min(place).alias("p")).select("geohash5", *[f"p.{c}" for c in places.PLACE_COLS], "p.source")

    def table(self, before: int | None = None) -> DataFrame:
        """One row per known cell, as of the batches before ``before`` (default: all)."""
        parts = []
        if self.base:
            known = places.known_places(self.base()).select("geohash5", *places.PLACE_COLS)
            parts.append(known.withColumn("source", F.lit(-1).cast("long")))
        resolved = self._resolved(before)
        if resolved is not None:
            parts.append(resolved)
        if not parts:
            return self.spark.createDataFrame([], PLACE_SCHEMA)
        return self._first(reduce(DataFrame.unionByName, parts)).drop("source")

    def fill(self, facts: DataFrame, resolver: places.Resolver, batch_id: int, seq, lat: str, lon: str) -> DataFrame:
        """Resolve and store the batch's new cells; the dictionary with them."""
        known = self.table(batch_id)
        path = f"{self.folder}/batch_id={batch_id}"
        places.resolve_missing(facts, known, resolver, seq=seq, lat=lat, lon=lon).write.mode("overwrite").parquet(path)
        return known.unionByName(self.spark.read.schema(PLACE_SCHEMA).parquet(path))

    def compact(self, keep_versions: int = 2) -> None:
        """Merge all batches but the last (a restart may write it again) into a new version.

        Nothing that a reader may have opened is overwritten; the batches and
        versions behind the newest ``keep_versions`` versions are then deleted.
        """
        ids = numbered_folders(self.spark, self.folder, "batch_id")
        merged = numbered_folders(self.spark, f"{self.folder}/merged", "upto")
        if len(ids) < 3 or (merged and ids[-2] <= merged[-1]):
            return
        upto = ids[-2]
        self._first(self._resolved(upto + 1)).write.mode("overwrite").parquet(f"{self.folder}/merged/upto={upto}")
        kept = [*merged, upto][-keep_versions:]
        for n in (n for n in merged if n not in kept):
            delete_path(self.spark, f"{self.folder}/merged/upto={n}")
        for n in (n for n in ids if n <= kept[0]):
            delete_path(self.spark, f"{self.folder}/batch_id={n}")


# --------------------------------------------------------------------------- P1

def enrich_batch(batch: DataFrame, place_table: DataFrame, names: DataFrame, on_missing: str = "null") -> DataFrame:
    """One batch of decoded rows (with or without ``geohash5``) -> rows with place and event name."""
    geo = batch if "geohash5" in batch.columns else with_geohash(batch, "latitude", "longitude")
    enriched = places.enrich_places(geo, place_table)
    return dictionary.lookup_event_names(enriched.drop("event_name"), names, fact_key="event_id",
                                         out_col="event_name", on_missing=on_missing)


def console_sink(rows_per_frame: int = 1000) -> Callable[[DataFrame, int], None]:
    """Print every row of each micro-batch (the print sink).

    Rows come to the driver a partition at a time; ``rows_per_frame`` only says
    how many are printed at once.
    """
    def show(df: DataFrame, batch_id: int) -> None:
        print(f"-- batch {batch_id}: {', '.join(df.columns)}")
        lines: list[str] = []
        for row in df.toLocalIterator():
            lines.append(", ".join("null" if v is None else str(v) for v in row))
            if len(lines) >= rows_per_frame:
                print("\n".join(lines))
                lines = []
        if lines:
            print("\n".join(lines))
    return show


def enrich_stream(payloads: DataFrame, load_places: Loader | None, load_dictionary: Loader | None,
                  output: str | None, checkpoint: str, resolver: places.Resolver | None = None,
                  place_output: str | None = None, trigger: dict | None = None,
                  on_corrupt: str = "error", name: str | None = None,
                  sink: Callable[[DataFrame, int], None] | None = None,
                  incremental_names=None, on_missing: str = "null") -> StreamingQuery:
    """P1: ``payloads`` has ``seq`` and binary ``payload``; results go to ``output/batch_id=N``
    (or to ``sink(rows, batch_id)``, e.g. ``console_sink()``).

    The dictionary is re-read for every micro-batch; with
    ``incremental_names`` (a ``sources.dictionary.IncrementalNames``) only the
    rows changed since the last poll are read and merged into a stored table.

    With a ``resolver``, unknown cells are resolved once and kept in
    ``place_output`` (see ``PlaceStore``); without ``load_places`` the
    dictionary starts empty.
    """
    if resolver is not None and not place_output:
        raise ValueError("a resolver needs place_output, where resolved cells are kept")
    decoded = decode_log_batches(payloads.select("seq", "payload"), on_corrupt=on_corrupt,
                                 keep=("seq",), item_col="item")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = PlaceStore(spark, place_output or f"{checkpoint}/no-places", load_places)
        if incremental_names is not None:
            names = incremental_names.refresh(batch_id).select("event_id", "event_name")
        else:
            names = dictionary.latest_names(load_dictionary())
        geo = with_geohash(batch, "latitude", "longitude")
        # With a resolver the rows are read twice (new cells, then the join).
        geo = geo.persist() if resolver is not None else geo
        try:
            table = (store.fill(geo, resolver, batch_id, ("seq", "item"), "latitude", "longitude")
                     if resolver is not None else store.table(batch_id))
            out = enrich_batch(geo, table, names, on_missing)
            if sink is not None:
                sink(out, batch_id)
            else:
                out.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")
        finally:
            geo.unpersist()

    return _start(decoded.writeStream.foreachBatch(run), checkpoint, trigger, name)


# --------------------------------------------------------------------------- P2

def _keyed(named: DataFrame) -> DataFrame:
    return named.select("seq", "uid", "event_name", F.col("event_type_name").alias("event_type"),
                        date_part("time").alias("dt"))


def _write_cells(batch: DataFrame, changes: str, batch_id: int, order: str) -> None:
    """Per cell of a micro-batch, the value written last (by ``order``)."""
    cells = (batch.groupBy("event_name", "first_dt", "event_type")
             .agg(F.max_by("cnt", order).alias("cnt"), F.max(order).alias("last_seq")))
    out = cells.select(F.concat_ws("|", "event_name", "first_dt").alias("board_key"), "event_type",
                       F.col("cnt").cast("string").alias("value"), "last_seq")
    sinks.write_changes(out, changes, batch_id)


def scoreboard_stream(lines: DataFrame, names: DataFrame, changes: str, checkpoint: str,
                      trigger: dict | None = None, on_missing: str = "null",
                      name: str | None = None,
                      after_batch: Callable[[int], None] | None = None) -> StreamingQuery:
    """P2: CSV ``lines`` (with ``seq``) -> cell changes in ``changes/batch_id=N``.

    The running count is a native streaming aggregation in update mode (count,
    first date and last row in order of arrival, state in the checkpoint).
    Arrival is the micro-batch, then ``seq``: a row with an older ``seq`` in a
    later batch arrives later.  Each micro-batch turns the updated keys into
    scoreboard cells; the current board is ``board_table(changes)``.  ``names``
    is a resolved dictionary; a JDBC-backed one is re-queried every micro-batch,
    and ``named_stream`` keeps up with a changing one of any kind.
    ``after_batch(batch_id)`` runs after a batch's changes are written
    (progress hooks, failure drills).
    """
    rows = decode.parse_csv_events(lines)
    return _counted_stream(_keyed(dictionary.lookup_event_names(rows, names, on_missing=on_missing)),
                           changes, checkpoint, trigger, name, after_batch)


def _counted_stream(keyed: DataFrame, changes: str, checkpoint: str, trigger: dict | None, name: str | None,
                    after_batch: Callable[[int], None] | None = None) -> StreamingQuery:
    # current_timestamp() is one value per micro-batch, the same when it is replayed.
    arrived = F.struct(F.unix_micros(F.current_timestamp()).alias("batch"), F.col("seq").alias("seq"))
    summary = metrics.arrival_summary(keyed.withColumn("arrived", arrived), F.col("arrived"))

    def run(batch: DataFrame, batch_id: int) -> None:
        _write_cells(batch.withColumn("last", F.col("last.seq")), changes, batch_id, "last")
        if after_batch is not None:
            after_batch(batch_id)

    return _start(summary.writeStream.outputMode("update").foreachBatch(run), checkpoint, trigger, name)


NAMED_SCHEMA = "uid string, event_name string, event_type string, dt string"


def named_stream(lines: DataFrame, load_names: Callable[[int], DataFrame], named: str, checkpoint: str,
                 trigger: dict | None = None, on_missing: str = "null", name: str | None = None) -> StreamingQuery:
    """The stateless half of P2 for a dictionary that changes while the job runs.

    Every micro-batch looks its rows up in ``load_names(batch_id)`` (e.g.
    ``IncrementalNames.refresh``) and writes them to ``named/batch_id=N``; a folder
    appears whole, and is never written again, so ``counted_stream`` may read it
    as a stream.
    """
    rows = decode.parse_csv_events(lines)

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch_id in numbered_folders(batch.sparkSession, named, "batch_id"):
            return
        found = dictionary.lookup_event_names(batch, load_names(batch_id).select("event_id", "event_name"),
                                              on_missing=on_missing)
        hidden = f"{checkpoint}/writing/batch_id={batch_id}"
        _keyed(found).write.mode("overwrite").parquet(hidden)
        publish_folder(batch.sparkSession, hidden, f"{named}/batch_id={batch_id}")

    return _start(rows.writeStream.foreachBatch(run), checkpoint, trigger, name)


def counted_stream(spark: SparkSession, named: str, changes: str, checkpoint: str, seq_type: str = "bigint",
                   trigger: dict | None = None, name: str | None = None,
                   max_files: int | None = None) -> StreamingQuery:
    """The stateful half: rows of ``named_stream`` -> cell changes in ``changes/batch_id=N``.

    Arrival is the batch in which a row was named, then ``seq``.
    """
    reader = spark.readStream.schema(f"seq {seq_type}, {NAMED_SCHEMA}, batch_id bigint")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    make_folder(spark, named)
    rows = reader.parquet(named)
    arrived = F.struct(F.col("batch_id").alias("batch"), F.col("seq").alias("seq"))
    summary = metrics.arrival_summary(rows.withColumn("arrived", arrived), F.col("arrived"))

    def run(batch: DataFrame, batch_id: int) -> None:
        _write_cells(batch, changes, batch_id, "last")

    return _start(summary.writeStream.outputMode("update").foreachBatch(run), checkpoint, trigger, name)


def scoreboard_rows_stream(lines: DataFrame, names: DataFrame, changes: str, checkpoint: str,
                           trigger: dict | None = None, on_missing: str = "null",
                           name: str | None = None) -> StreamingQuery:
    """P2 with per-row running counts (first date by arrival, for unkeyed topics).

    Every row's running count is computed with per-key state
    (``stateful.running_count_rows``) and written into the cell of its key's
    first-seen date; per micro-batch the row with the greatest seq of each
    cell is the last writer.
    """
    from driftlog.streaming.stateful import running_count_rows

    rows = decode.parse_csv_events(lines)
    counted = running_count_rows(_keyed(dictionary.lookup_event_names(rows, names, on_missing=on_missing)))

    def run(batch: DataFrame, batch_id: int) -> None:
        _write_cells(batch, changes, batch_id, "seq")

    return _start(counted.writeStream.outputMode("append").foreachBatch(run), checkpoint, trigger, name)


CHANGE_ORDER = ("batch_id", "last_seq")


def _change_log(spark: SparkSession, changes: str, after: int = -1, upto: int | None = None) -> DataFrame | None:
    ids = [n for n in numbered_folders(spark, changes, "batch_id") if n > after and (upto is None or n <= upto)]
    if not ids:
        return None
    return spark.read.option("basePath", changes).parquet(*[f"{changes}/batch_id={n}" for n in ids])


def board_table(spark, changes: str, snapshot: str | None = None) -> DataFrame:
    """Current scoreboard from the change log: per cell, the value that arrived last.

    Later micro-batches win, and inside one the greatest order.  With a
    ``snapshot`` folder from ``compact_changes`` its newest version is read, and of
    the log only the batches after it.
    """
    done = numbered_folders(spark, snapshot, "upto") if snapshot else []
    log = _change_log(spark, changes, done[-1] if done else -1)
    if done:
        held = spark.read.parquet(f"{snapshot}/upto={done[-1]}")
        log = held if log is None else log.unionByName(held)
    if log is None:
        return spark.createDataFrame([], "board_key string, event_type string, value string")
    return sinks.kv_table(log, order=CHANGE_ORDER)


def compact_changes(spark, changes: str, snapshot: str, trim: bool = False) -> None:
    """Fold the newest snapshot and the batches after it into a new version, ``snapshot/upto=N``.

    The log before the last snapshot is not read again, and readers keep the
    version they have until the new one is complete.  ``trim`` deletes the batches
    folded in and the versions before the last two.  The newest batch stays in
    the log: a restarted query may write it again.
    """
    done = numbered_folders(spark, snapshot, "upto")
    ids = [n for n in numbered_folders(spark, changes, "batch_id") if not done or n > done[-1]][:-1]
    if not ids:
        return
    log = _change_log(spark, changes, done[-1] if done else -1, ids[-1])
    if done:
        log = log.unionByName(spark.read.parquet(f"{snapshot}/upto={done[-1]}"))
    last = F.struct("batch_id", "last_seq", "value")
    table = log.groupBy("board_key", "event_type").agg(F.max(last).alias("w"))
    (table.select("board_key", "event_type", "w.value", "w.last_seq", F.col("w.batch_id").alias("batch_id"))
     .write.mode("overwrite").parquet(f"{snapshot}/upto={ids[-1]}"))
    if trim:
        for n in ids:
            delete_path(spark, f"{changes}/batch_id={n}")
        for n in done[:-1]:
            delete_path(spark, f"{snapshot}/upto={n}")


def active_users_stream(rows: DataFrame, changes: str, checkpoint: str,
                        keys: tuple[str, ...] = ("event_name", "dt", "event_type"), user: str = "uid",
                        trigger: dict | None = None, name: str | None = None,
                        event_time: str | None = None, late: str = "1 day") -> StreamingQuery:
    """Distinct users per activity, day and type on a stream (A5).

    Exact ``count(distinct)`` is not supported on streams; the same number is
    ``dropDuplicates(keys + user)`` followed by a count per key (both states
    in the checkpoint).  Each micro-batch writes the updated counts to
    ``changes/batch_id=N``; ``uv_table`` reads the latest count per key.

    With ``event_time`` (a timestamp of the day the keys speak of) both states
    drop a day once the watermark is ``late`` past its end; later rows of that
    day are ignored.  Without it state is kept for good.
    """
    kept = list(keys)
    if event_time:
        rows = rows.withWatermark(event_time, late).withColumn("_day", F.window(event_time, "1 day"))
        kept = [*keys, "_day"]
    first_seen = rows.select(*kept, user).dropDuplicates([*kept, user])
    counts = first_seen.groupBy(*kept).agg(F.count(F.lit(1)).alias("uv"))

    def run(batch: DataFrame, batch_id: int) -> None:
        sinks.write_changes(batch.select(*keys, "uv"), changes, batch_id)

    return _start(counts.writeStream.outputMode("update").foreachBatch(run), checkpoint, trigger, name)


def uv_table(spark, changes: str, keys: tuple[str, ...] = ("event_name", "dt", "event_type")) -> DataFrame:
    """Latest distinct-user count per key (counts only grow, so the max is the latest)."""
    return spark.read.parquet(changes).groupBy(*keys).agg(F.max("uv").alias("uv"))


# --------------------------------------------------------------------------- P3

def split_batch(batch: DataFrame, place_table: DataFrame, keep_ts: bool = False) -> DataFrame:
    """Parsed JSON rows (with or without ``geohash5``) -> ``seq, event_type, json[, ts]`` with places filled in."""
    geo = batch if "geohash5" in batch.columns else with_geohash(batch, "wd", "jd")
    enriched = places.enrich_places(geo.drop("area"), place_table).withColumnRenamed("district", "area")
    return decode.encode_json_events(enriched, out_col="json",
                                     keep=("seq", "event_type") + (("ts",) if keep_ts else ()))


def split_archive_batch(batch: DataFrame, store: PlaceStore, batch_id: int, routes_out: str,
                        archive_out: str, clock: str | None = None, kafka_opts: dict | None = None,
                        resolver: places.Resolver | None = None) -> None:
    """Enrich one batch, send side routes, archive the main stream by hour."""
    geo = with_geohash(batch, "wd", "jd")
    # With a resolver the rows are read twice (new cells, then the join).
    geo = geo.persist() if resolver is not None else geo
    coded = None
    try:
        table = (store.fill(geo, resolver, batch_id, "seq", "wd", "jd") if resolver is not None
                 else store.table(batch_id))
        coded = split_batch(geo, table, keep_ts=bool(clock)).persist()
        side = route.with_route(coded, "event_type").where(F.col("route").isNotNull())
        if kafka_opts is not None:
            # Keyed by arrival order: a reader can drop what a replay sends again.
            (sinks.to_topic_records(side, key_col="seq").write.format("kafka").options(**kafka_opts).save())
        else:
            side.select("route", "seq", "json").write.mode("overwrite").partitionBy("route") \
                .parquet(f"{routes_out}/batch_id={batch_id}")
        main = sinks.with_archive_bucket(coded, clock=clock)
        sinks.write_archive_batch(main, archive_out, batch_id, line_col="json")
    finally:
        if coded is not None:
            coded.unpersist()
        geo.unpersist()


def split_archive_stream(lines: DataFrame, load_places: Loader | None, routes_out: str, archive_out: str,
                         checkpoint: str, clock: str | None = None, kafka_opts: dict | None = None,
                         trigger: dict | None = None, name: str | None = None,
                         resolver: places.Resolver | None = None,
                         place_output: str | None = None,
                         compact_every: int | None = None, roll_ms: int | None = None) -> StreamingQuery:
    """P3: JSON ``lines`` (with ``seq``) -> side routes + hourly archive under ``archive_out``.

    ``clock=None`` files rows by processing time (the reference); pass a
    timestamp column name to file by event time.  A batch's archive folder is
    overwritten as a whole, so a replayed batch does not duplicate, in whatever
    hour it is replayed; every ``compact_every`` batches, or once the oldest is
    ``roll_ms`` old or they are large enough for a file (``sinks.roll_due``), the
    folders are merged into large files, and those of resolved places, too.
    ``sinks.read_stream_archive`` reads it all.
    """
    if resolver is not None and not place_output:
        raise ValueError("a resolver needs place_output, where resolved cells are kept")
    keep = ("seq",) + ((clock,) if clock else ())
    parsed = decode.parse_json_events(lines, keep=keep)
    if clock:
        parsed = parsed.withColumnRenamed(clock, "ts")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = PlaceStore(spark, place_output or f"{checkpoint}/no-places", load_places)
        split_archive_batch(batch, store, batch_id, routes_out, archive_out, clock="ts" if clock else None,
                            kafka_opts=kafka_opts, resolver=resolver)
        counted = compact_every and batch_id and batch_id % compact_every == 0
        if counted or (roll_ms is not None and sinks.roll_due(spark, archive_out, roll_ms)):
            sinks.compact_archive(spark, archive_out)
            if resolver is not None:
                store.compact()

    return _start(parsed.writeStream.foreachBatch(run), checkpoint, trigger, name)
