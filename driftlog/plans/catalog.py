"""Registered queries: one per operator key, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the supplied tables in full (through the derivations in
``driftlog.plans.derived``) and applies the library operators; the output
column names are the contract shared with ``driftlog.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlog.functions.clock import DAY, HOUR, micros
from driftlog.operators import asof, cubes, decode, dictionary, intervals, metrics, places, route, sessions, sinks, sketches, topk, windows
from driftlog.operators.joins import stage_table
from driftlog.plans import derived
from driftlog.session import STREAM_CONF, conf_set, shared_path
from driftlog.sources import protobuf
from driftlog.sources.dictionary import IncrementalNames
from driftlog.streaming import windows as stream_windows

Query = Callable[[SparkSession, str], DataFrame]

# Fixed value: the dictionary bound of the incremental-poll query.
POLL_BOUND = "2024-01-10"
# The days up to which three polls see the dictionary (None: all of it), and a number of batches.
POLL_DAYS = ("2024-01-15", "2024-01-20", None)
CHANGE_BATCHES = 3
# Fixed values of the event-time queries: pairs, sessions, windows, lateness, rows of a top list and a heavy share.
PAIR_WITHIN = 2 * HOUR
SESSION_GAP = 8 * HOUR
TUMBLING, TUMBLING_DELAY = 6 * HOUR, 12 * HOUR
SLIDING, SLIDE, SLIDING_DELAY = DAY, 6 * HOUR, DAY
TOP_USERS = 3
HEAVY_SHARE = 0.04
SKETCH_BOUND = 0.05
# Fixed values of the queries that run a stream: parts in which the log arrives, expiry of counts, wait for a name, watermark delay.
STREAM_PARTS = 3
# Fixed value: users whose running counts are one state value.
USERS_PER_BUCKET = 400
COUNT_IDLE = 6 * HOUR
NAME_WAIT = 2 * DAY
STREAM_DELAY = DAY


def q_decode_log_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = derived.log(spark, sf_dir)
    beans = lg.select("uid", F.col("type_id").alias("event_id"), "event_name", "province",
                      F.col("lon").alias("longitude"), F.col("lat").alias("latitude"))
    return protobuf.decode_log_batches(protobuf.encode_log_batches(beans))


def q_parse_csv_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.parse_csv_events(derived.csv_lines(spark, sf_dir))


def q_parse_json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = decode.parse_json_events(derived.json_lines(spark, sf_dir))
    return parsed.select("seq", "uid", "time", "event_type", "jd", "wd")


def _json_beans(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = derived.log(spark, sf_dir)
    nothing = F.lit(None).cast("string")
    return lg.select("seq", "ts", "uid", "time", F.col("route_type").alias("event_type"),
                     F.col("lon").alias("jd"), F.col("lat").alias("wd"),
                     nothing.alias("province"), nothing.alias("city"), nothing.alias("area"))


def q_encode_json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.encode_json_events(_json_beans(spark, sf_dir))


def q_geohash5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.log_geo(spark, sf_dir).select("seq", "geohash5")


def q_place_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = derived.log_geo(spark, sf_dir).select("seq", "geohash5", "province")
    out = places.enrich_places(facts, derived.places(spark, sf_dir))
    return out.select("seq", "geohash5", "province", "city", "district")


def _resolver(spark: SparkSession, sf_dir: str) -> places.Resolver:
    return derived.nation_resolver(derived.table(spark, sf_dir, "nation"), derived.table(spark, sf_dir, "region"))


def q_place_cache_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places.fill_place_cache(derived.log_geo(spark, sf_dir), derived.places(spark, sf_dir),
                                   _resolver(spark, sf_dir))


def q_place_parse_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = derived.all_places(spark, sf_dir)
    text = lambda c: F.concat(F.lit('"'), F.coalesce(c, F.lit("")), F.lit('"'))
    response = F.concat(F.lit('{"regeocode":{"addressComponent":{"province":'), text(p.province),
                        F.lit(',"city":'), F.when(p.city_list, "[]").otherwise(text(p.city)),
                        F.lit(',"district":'), text(p.district), F.lit("}}}"))
    return places.parse_geocoder_response(p.select("geohash5", response.alias("response")))


def q_place_dict_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places.decode_place_text(places.encode_place_text(derived.all_places(spark, sf_dir)))


def q_event_name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = dictionary.latest_names(derived.dictionary(spark, sf_dir))
    facts = derived.log(spark, sf_dir).select("seq", "type_id")
    return dictionary.lookup_event_names(facts, names).select("seq", "type_id", "event_type_name")


def q_dict_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.latest_names(derived.dictionary(spark, sf_dir))


def q_dict_poll_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.poll_order_names(derived.dictionary(spark, sf_dir))


def q_dict_incremental_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.incremental_poll(derived.dictionary(spark, sf_dir), POLL_BOUND)


def q_running_user_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = derived.log(spark, sf_dir).select("seq", "event_name", "event_type", "uid", "dt")
    return metrics.running_count(lg).select("seq", "event_name", "event_type", "uid", "first_dt", "cnt")


def q_running_count_unknown_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts where the dictionary lacks an id: its rows have a null type and are counted all the same."""
    names = dictionary.latest_names(derived.dictionary(spark, sf_dir)).where("event_id != '2'")
    named = dictionary.lookup_event_names(derived.log(spark, sf_dir).drop("event_type"), names, out_col="event_type")
    counted = metrics.running_count(named.select("seq", "event_name", "event_type", "uid", "dt"))
    return counted.select("seq", "event_name", "event_type", "uid", "first_dt", "cnt")


def q_parse_csv_line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.parse_csv_events(derived.csv_line_ends(spark, sf_dir))


def q_parse_json_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = decode.parse_json_events(derived.json_trailing(spark, sf_dir))
    return parsed.select("seq", "uid", "time", "event_type", "jd", "wd")


def q_dict_after_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary after three polls, each seeing the versions up to its day and starting from the stored bound."""
    versions = derived.dictionary(spark, sf_dir)
    store = shared_path(spark, "names", unique=True)
    for k, day in enumerate(POLL_DAYS):
        seen = versions if day is None else versions.where(F.col("last_update") <= day)
        # A new poller each time, as after a restart.
        names = IncrementalNames(spark, lambda seen=seen: seen, store, first_bound=POLL_BOUND).refresh(k)
    return names.select("event_id", "event_name", "last_update")


def q_scoreboard_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board after its change log was written in three batches (rows out of order), partly folded."""
    from driftlog.streaming.jobs import board_table, compact_changes
    lg = derived.log(spark, sf_dir)
    changes, snapshot = shared_path(spark, "changes", unique=True), shared_path(spark, "board", unique=True)
    for batch in range(CHANGE_BATCHES):
        part = lg.where(F.col("seq") * 7 % CHANGE_BATCHES == batch)
        cells = part.select(F.concat_ws("|", "event_name", "dt").alias("board_key"), "event_type",
                            F.col("uid").alias("value"), F.col("seq").alias("last_seq"))
        sinks.write_changes(cells, changes, batch)
        if batch == 1:
            compact_changes(spark, changes, snapshot)
    return board_table(spark, changes, snapshot)


def q_archive_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's archive: three batches, one of them written twice, two merged, summarised per hour."""
    beans = _json_beans(spark, sf_dir)
    fields = {"eventType": "event_type", "seq": "seq", "uid": "uid"}
    lines = decode.encode_json_events(beans, out_col="line", keep=("ts", "seq"), fields=fields)
    filed = sinks.with_archive_bucket(lines, clock="ts")
    path = shared_path(spark, "stream-archive", unique=True)
    for batch in (0, 1, 1, 2):
        sinks.write_archive_batch(filed.where(F.col("seq") % 3 == batch), path, batch)
    sinks.compact_archive(spark, path)
    seq = F.get_json_object("value", "$.seq").cast("long")
    return sinks.read_stream_archive(spark, path).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"))


def q_activity_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.page_views(derived.log(spark, sf_dir))


def q_activity_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.active_users(derived.log(spark, sf_dir))


def q_activity_scoreboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.activity_scoreboard(derived.log(spark, sf_dir))


def q_route_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = derived.log(spark, sf_dir).select("seq", "route_type")
    return route.route_events(lg, type_col="route_type")


def q_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.route_counts(q_route_events(spark, sf_dir))


def q_archive_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the main stream into hourly folders, read it back, summarise per folder."""
    beans = _json_beans(spark, sf_dir)
    fields = {"area": "area", "city": "city", "eventType": "event_type", "jd": "jd",
              "province": "province", "seq": "seq", "time": "time", "uid": "uid", "wd": "wd"}
    lines = decode.encode_json_events(beans, out_col="line", keep=("ts", "seq"), fields=fields)
    path = shared_path(spark, "archive", unique=True)
    sinks.write_archive(sinks.with_archive_bucket(lines, clock="ts"), path)
    back = sinks.read_archive(spark, path)
    seq = F.get_json_object("value", "$.seq").cast("long")
    return back.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(seq).alias("first_seq"),
                                      F.max(seq).alias("last_seq"))


def q_kv_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = derived.log(spark, sf_dir)
    writes = lg.select(F.concat_ws("|", "event_name", "dt").alias("board_key"), "event_type",
                       F.col("uid").alias("value"), "seq")
    return sinks.kv_table(writes)


def q_activity_count_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole activity-count job: CSV lines -> names -> running counts -> scoreboard."""
    from driftlog.plans.flagship import scoreboard_job
    return scoreboard_job(spark, sf_dir)


def q_enrich_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole protobuf enrichment job: batches -> rows -> place (cache-aside) -> event name."""
    from driftlog.streaming.jobs import enrich_batch
    lg = derived.log(spark, sf_dir)
    beans = lg.select("seq", "uid", F.col("type_id").alias("event_id"), F.col("lon").alias("longitude"),
                      F.col("lat").alias("latitude"))
    payloads = protobuf.encode_log_batches(beans, seq_col="seq")
    rows = protobuf.decode_log_batches(payloads, keep=("seq",), item_col="item")
    names = dictionary.latest_names(derived.dictionary(spark, sf_dir))
    geo = places.with_geohash5(rows, "latitude", "longitude")
    geo = stage_table(geo, "decoded")
    _, grown = places.enrich_with_fill(geo, derived.places(spark, sf_dir), _resolver(spark, sf_dir),
                                       seq=("seq", "item"), lat="latitude", lon="longitude")
    out = enrich_batch(geo, grown, names)
    return out.select("uid", "event_id", "event_name", "province", "city", "district", "longitude", "latitude")


def q_split_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole JSON routing job: lines -> rows -> place (cache-aside) -> JSON text -> routes."""
    from driftlog.streaming.jobs import split_batch
    parsed = places.with_geohash5(decode.parse_json_events(derived.json_lines(spark, sf_dir)), "wd", "jd")
    parsed = stage_table(parsed, "parsed")
    _, grown = places.enrich_with_fill(parsed, derived.places(spark, sf_dir), _resolver(spark, sf_dir), lat="wd", lon="jd")
    return route.route_events(split_batch(parsed, grown), "event_type").select("seq", "route", "json")


def q_event_name_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the type name that was valid at its time."""
    facts = derived.log(spark, sf_dir).select("seq", F.col("type_id").alias("event_id"), "ts")
    named = asof.asof_join(facts, derived.name_versions(spark, sf_dir), ("event_id",), "ts", "valid_from", ("type_name",))
    return named.select("seq", "event_id", "type_name")


def q_last_view_before_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase with the same user's last view before it, and how long before."""
    lg = derived.log(spark, sf_dir)
    bought = lg.where("event_type = 'purchase'").select("seq", "uid", "ts")
    seen = lg.where("event_type = 'view'").select("uid", F.col("ts").alias("view_ts"), F.col("seq").alias("view_seq"))
    out = asof.asof_join(bought, seen, ("uid",), "ts", "view_ts", ("view_seq", "view_ts"), tie=("view_seq",))
    clock = lambda c: micros(F.col(c), out.schema[c].dataType)
    return out.select("seq", "uid", "view_seq", (clock("ts") - clock("view_ts")).alias("since_us"))


def q_view_purchase_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a view and a purchase of one user, the purchase at most two hours after the view."""
    lg = derived.log(spark, sf_dir)
    seen = lg.where("event_type = 'view'").select("uid", F.col("seq").alias("view_seq"), F.col("ts").alias("view_ts"))
    bought = lg.where("event_type = 'purchase'").select("uid", F.col("seq").alias("purchase_seq"), F.col("ts").alias("purchase_ts"))
    pairs = intervals.interval_join(seen, bought, ("uid",), "view_ts", "purchase_ts", 0, PAIR_WITHIN, gap_col="gap_us")
    return pairs.select("uid", "view_seq", "purchase_seq", "gap_us")


def q_user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.sessionize(derived.log(spark, sf_dir), ("uid",), "ts", SESSION_GAP)


def q_tumbling_counts_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and six hours as they arrive day by day; what comes after its window was closed is counted apart."""
    return windows.windowed_counts(derived.arrivals(spark, sf_dir), ("event_type",), "ts", TUMBLING, batch="batch", delay=TUMBLING_DELAY)


def q_sliding_counts_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per activity and day, a new day every six hours, late rows apart."""
    return windows.windowed_counts(derived.arrivals(spark, sf_dir), ("event_name",), "ts", SLIDING, SLIDE, "batch", SLIDING_DELAY)


def q_weekly_users_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users per activity and week from stored daily sketches, held against the exact number."""
    lg = derived.log(spark, sf_dir)
    daily = stage_table(sketches.user_sketches(lg), "user-sketches")
    week = F.trunc(F.to_date("dt"), "week").cast("string").alias("week")
    rolled = sketches.roll_up(daily.withColumn("week", week), ("event_name", "week"))
    exact = metrics.active_users(lg.withColumn("week", week), ("event_name", "week"), out_col="users_exact")
    close = F.abs(sketches.estimate() - F.col("users_exact")) <= SKETCH_BOUND * F.col("users_exact")
    return rolled.join(exact, ["event_name", "week"]).select("event_name", "week", "n_events", "users_exact", close.alias("estimate_close"))


def q_activity_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = ("event_name", "dt", "event_type")
    return cubes.grouping_sets(derived.log(spark, sf_dir), dims, cubes.cube_sets(dims))


def q_activity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = ("event_type", "event_name", "dt")
    return cubes.grouping_sets(derived.log(spark, sf_dir), dims, cubes.rollup_sets(dims))


def q_top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users with most events of each activity and day, ties by user."""
    views = metrics.page_views(derived.log(spark, sf_dir), ("event_name", "dt", "uid"))
    return topk.top_k(views, ("event_name", "dt"), [F.desc("pv"), F.col("uid")], TOP_USERS)


def q_heavy_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity and type pairs that hold over four percent of all events."""
    lg = derived.log(spark, sf_dir).select(F.concat_ws("|", "event_name", "event_type").alias("activity_type"))
    return topk.heavy_hitters(lg, "activity_type", HEAVY_SHARE)


def _streamed(spark: SparkSession, arriving: list[dict[str, DataFrame]], make: Callable[..., DataFrame]) -> DataFrame:
    """What a stream gives for inputs that arrive in parts: after each part the query is started anew and takes what is there.

    ``arriving`` holds, for each part, the rows of every input by name; ``make``
    gets the inputs as streams.  State is kept in RocksDB.
    """
    root = shared_path(spark, "streamed", unique=True)
    with conf_set(spark, STREAM_CONF):
        for part in arriving:
            for name, rows in part.items():
                rows.write.mode("append").parquet(f"{root}/{name}")
            inputs = {name: spark.readStream.schema(rows.schema).parquet(f"{root}/{name}") for name, rows in part.items()}
            out = make(**inputs)
            writer = out.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").outputMode("append")
            writer.trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out")


def _by_time(like: DataFrame, others: tuple[tuple[DataFrame, str], ...] = (), time: str = "ts", parts: int = STREAM_PARTS) -> list:
    """The rows of ``like`` in ``parts`` spans of its time, in order; of ``others`` (with their time) those of the same spans."""
    clock = lambda df, c: micros(F.col(c), df.schema[c].dataType)
    low, high = like.agg(F.min(clock(like, time)), F.max(clock(like, time))).first()
    step = ((high or 0) - (low or 0)) // parts + 1
    span = lambda df, c: F.floor((clock(df, c) - F.lit(low or 0)) / F.lit(step))
    dealt = [[df.where(F.least(F.greatest(span(df, c), F.lit(0)), F.lit(parts - 1)) == k) for k in range(parts)]
             for df, c in ((like, time), *others)]
    return list(zip(*dealt)) if others else dealt[0]


def q_user_sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions of ``user_sessions`` from a stream; a last row two days later closes them all."""
    lg = derived.log(spark, sf_dir).select("uid", "ts")
    end = lg.agg(F.max("ts").alias("ts")).select(F.lit("end of log").alias("uid"), (F.col("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts"))
    found = _streamed(spark, [{"log": rows} for rows in [*_by_time(lg), end]],
                      lambda log: stream_windows.sessions_stream(log, ("uid",), "ts", SESSION_GAP, STREAM_DELAY))
    return found.where("uid != 'end of log'")


def q_expiring_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts per user and type that start anew after six hours without such an event, from a stream."""
    from driftlog.streaming.timers import expiring_counts_stream
    lg = derived.log(spark, sf_dir).select("seq", "uid", "event_type", "ts")
    users = lg.agg(F.approx_count_distinct("uid")).first()[0]
    buckets = max(16, -(-users // USERS_PER_BUCKET))
    return _streamed(spark, [{"log": rows} for rows in _by_time(lg)],
                     lambda log: expiring_counts_stream(log, ("uid",), "event_type", "seq", "ts", COUNT_IDLE, STREAM_DELAY, buckets))


def q_named_when_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams, events and dictionary rows: each event once, named if its id's first name comes within two days."""
    from driftlog.streaming.timers import named_when_known_stream
    facts = derived.log(spark, sf_dir).select("seq", F.col("type_id").alias("event_id"), "ts")
    versions = derived.name_versions(spark, sf_dir)
    first = versions.groupBy("event_id").agg(F.min_by("type_name", "valid_from").alias("type_name"), F.min("valid_from").alias("valid_from"))
    end = facts.agg(F.max("ts").alias("ts")).select(F.lit(-1).cast("long").alias("seq"), F.lit("end of log").alias("event_id"),
                                                    (F.col("ts") + F.expr("INTERVAL 5 DAYS")).alias("ts"))
    after = end.select("event_id", F.lit("end").alias("type_name"), F.col("ts").alias("valid_from"))
    parts = [{"events": a, "names": b} for a, b in [*_by_time(facts, ((first, "valid_from"),)), (end, after)]]
    found = _streamed(spark, parts, lambda events, names: named_when_known_stream(
        events, names, "event_id", "seq", "ts", "type_name", "valid_from", NAME_WAIT, STREAM_DELAY, parts=4))
    return found.where("seq >= 0")


def q_first_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as it comes from a source that sends each part twice and one event in five three times: first copies only."""
    lg = derived.log(spark, sf_dir).select("seq", "uid", "event_type", "ts")
    parts = [rows.unionByName(rows.where("seq % 5 = 0")) for rows in _by_time(lg)]
    return _streamed(spark, [{"log": rows} for rows in (parts[0], parts[0], parts[1], parts[1].unionByName(parts[2]), parts[2])],
                     lambda log: stream_windows.first_copies_stream(log, ("seq",), "ts", 20 * DAY)).select("seq", "uid", "event_type")


QUERIES: dict[str, Query] = {
    "decode_log_batches": q_decode_log_batches,
    "parse_csv_events": q_parse_csv_events,
    "parse_json_events": q_parse_json_events,
    "parse_csv_line_ends": q_parse_csv_line_ends,
    "parse_json_trailing": q_parse_json_trailing,
    "encode_json_events": q_encode_json_events,
    "geohash5": q_geohash5,
    "place_enrich": q_place_enrich,
    "place_cache_fill": q_place_cache_fill,
    "place_parse_response": q_place_parse_response,
    "place_dict_codec": q_place_dict_codec,
    "event_name_lookup": q_event_name_lookup,
    "dict_latest": q_dict_latest,
    "dict_poll_order": q_dict_poll_order,
    "dict_incremental_poll": q_dict_incremental_poll,
    "dict_after_polls": q_dict_after_polls,
    "running_user_count": q_running_user_count,
    "running_count_unknown_type": q_running_count_unknown_type,
    "activity_pv": q_activity_pv,
    "activity_uv": q_activity_uv,
    "activity_scoreboard": q_activity_scoreboard,
    "route_events": q_route_events,
    "route_counts": q_route_counts,
    "scoreboard_from_changes": q_scoreboard_from_changes,
    "archive_hourly": q_archive_hourly,
    "archive_compacted": q_archive_compacted,
    "kv_latest": q_kv_latest,
    "activity_count_job": q_activity_count_job,
    "enrich_job": q_enrich_job,
    "split_job": q_split_job,
    "event_name_asof": q_event_name_asof,
    "last_view_before_purchase": q_last_view_before_purchase,
    "view_purchase_pairs": q_view_purchase_pairs,
    "user_sessions": q_user_sessions,
    "tumbling_counts_late": q_tumbling_counts_late,
    "sliding_counts_late": q_sliding_counts_late,
    "weekly_users_sketch": q_weekly_users_sketch,
    "activity_cube": q_activity_cube,
    "activity_rollup": q_activity_rollup,
    "top_users": q_top_users,
    "heavy_activities": q_heavy_activities,
    "user_sessions_stream": q_user_sessions_stream,
    "expiring_counts": q_expiring_counts,
    "named_when_known": q_named_when_known,
    "first_copies": q_first_copies,
}
