"""Log-shaped inputs derived from the supplied test tables.

The supplied ``events`` table plays the user-behaviour log; every other
input (CSV text, JSON text, protobuf batches, the event dictionary and the
place dictionary) is derived from it -- and from ``nation``/``region`` --
by deterministic rules, so that the same rows can be rebuilt in DuckDB SQL
(see ``driftlog.plans.oracle``).  All derivations are lazy DataFrames over
the whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlog.functions.geohash import with_geohash


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _type_case(col, mapping: dict, default: str):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(default)


# Event type -> type id, and event type -> routed event type.
TYPE_IDS = {"click": "1", "view": "2", "purchase": "3", "signup": "4"}
TYPE_ID_OTHER = "5"
ROUTE_TYPES = {"click": "flow_click", "view": "flow_view",
               "purchase": "acitiv_purchase", "signup": "activity_signup"}
ROUTE_TYPE_OTHER = "error"


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log row per event: seq, ts, uid, event_name, time, dt, event_type, ..."""
    ev = table(spark, sf_dir, "events")
    ts_text = ev.ts.cast("string")
    return ev.select(
        F.col("event_id").alias("seq"),
        F.col("ts"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("uid"),
        F.concat(F.lit("act"), (F.col("user_id") % 5).cast("string")).alias("event_name"),
        F.substring(ts_text, 1, 19).alias("time"),
        F.substring(ts_text, 1, 10).alias("dt"),
        F.col("event_type"),
        _type_case(F.col("event_type"), TYPE_IDS, TYPE_ID_OTHER).alias("type_id"),
        _type_case(F.col("event_type"), ROUTE_TYPES, ROUTE_TYPE_OTHER).alias("route_type"),
        F.concat(F.lit("p"), (F.col("user_id") % 7).cast("string")).alias("province"),
        (F.lit(73.0) + ((F.col("user_id") * 37) % 620).cast("double") / F.lit(10.0)).alias("lon"),
        (F.lit(18.0) + ((F.col("user_id") * 53 + F.col("event_id") % 3) % 350).cast("double")
         / F.lit(10.0)).alias("lat"),
    )


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV text of the log; some lines are deliberately unusable."""
    lg = log(spark, sf_dir)
    sep = F.lit(",")
    full = F.concat(lg.uid, sep, lg.event_name, sep, lg.time, sep, lg.type_id, sep, lg.province)
    line = (F.when(lg.seq % 11 == 0, F.concat(lg.uid, sep, lg.event_name, sep, lg.time, sep, lg.type_id, sep))
            .when(lg.seq % 13 == 0, F.concat(lg.uid, sep, lg.event_name, sep, lg.time))
            .when(lg.seq % 17 == 0, F.concat(full, F.lit(",x")))
            .otherwise(full))
    return lg.select("seq", line.alias("line"))


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text of the log: truncated, unparseable, missing and quoted numbers."""
    lg = log(spark, sf_dir)
    q = F.lit('"')
    head = F.concat(F.lit('{"uid":"'), lg.uid)
    mid = F.concat(head, F.lit('","time":"'), lg.time, F.lit('","eventType":"'), lg.route_type)
    line = (F.when(lg.seq % 11 == 0, head)
            .when(lg.seq % 13 == 0, F.concat(head, F.lit('","jd":"abc"}')))
            .when(lg.seq % 17 == 0, F.concat(mid, q, F.lit(',"wd":'), lg.lat.cast("string"), F.lit("}")))
            .otherwise(F.concat(mid, F.lit('","jd":"'), lg.lon.cast("string"), q,
                                F.lit(',"wd":'), lg.lat.cast("string"), F.lit("}"))))
    return lg.select("seq", line.alias("line"))


def log_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = log(spark, sf_dir)
    return with_geohash(lg, "lat", "lon")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every geohash cell of the log with the first event seen in it."""
    return log_geo(spark, sf_dir).groupBy("geohash5").agg(F.min("seq").alias("first_seq"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place dictionary covering part of the cells (even first_seq only)."""
    c = cells(spark, sf_dir)
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (c.where(c.first_seq % 2 == 0)
            .join(nation, nation.n_nationkey == c.first_seq % 25)
            .join(region, region.r_regionkey == nation.n_regionkey)
            .select("geohash5", F.col("r_name").alias("province"), F.col("n_name").alias("city"),
                    F.concat(F.lit("d"), (c.first_seq % 7).cast("string")).alias("district")))


def all_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place for every cell; some have no city (or a list of cities) or no district, by rule."""
    c = cells(spark, sf_dir)
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (c.join(nation, nation.n_nationkey == c.first_seq % 25)
            .join(region, region.r_regionkey == nation.n_regionkey)
            .select("geohash5", F.col("r_name").alias("province"),
                    F.when(~(c.first_seq % 5).isin(1, 2), F.col("n_name")).alias("city"),
                    F.when(c.first_seq % 7 != 3, F.concat(F.lit("d"), (c.first_seq % 7).cast("string"))).alias("district"),
                    (c.first_seq % 5 == 2).alias("city_list")))


def nation_resolver(nation: DataFrame, region: DataFrame, district: str = "d_new"):
    """Offline stand-in for a geocoder: cell -> nation ``floor(lon + lat) % 25``.

    A cell whose nation is not found keeps its row, without names.
    """
    def resolve(cells: DataFrame) -> DataFrame:
        n = nation.select("n_nationkey", "n_name", "n_regionkey")
        r = region.select("r_regionkey", "r_name")
        keyed = cells.withColumn("_nk", F.pmod(F.floor(F.col("lon") + F.col("lat")).cast("long"), F.lit(25)))
        return (keyed.join(n, keyed._nk == n.n_nationkey, "left")
                .join(r, n.n_regionkey == r.r_regionkey, "left")
                .select("geohash5", F.col("r_name").alias("province"), F.col("n_name").alias("city"),
                        F.lit(district).alias("district")))
    return resolve


def csv_line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV lines with a line end left on some; where the last field is empty it is then the field."""
    lines = csv_lines(spark, sf_dir)
    end = F.when(F.col("seq") % 5 == 0, "\n").when(F.col("seq") % 7 == 0, "\r").otherwise("")
    return lines.select("seq", F.concat("line", end).alias("line"))


def json_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON lines with blanks, a second object, text or a bracket behind some, and empty coordinates."""
    lines = json_lines(spark, sf_dir)
    s = F.col("seq")
    tail = (F.when(s % 5 == 0, " \n").when(s % 7 == 0, '{"uid":"second"}').when(s % 19 == 0, " trailing text")
            .when(s % 23 == 0, "]").when(s % 29 == 0, "}").when(s % 31 == 0, ',{"uid":"second"}').otherwise(""))
    line = F.when(s % 37 == 0, F.regexp_replace("line", '"jd":"[0-9.]+"', '"jd":""')).otherwise(F.col("line"))
    return lines.select("seq", F.concat(line, tail).alias("line"))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many-version event dictionary: one row per (id, day) version."""
    lg = log(spark, sf_dir)
    return lg.select(
        F.col("type_id").alias("event_id"),
        F.concat(lg.event_type, F.lit("_v"), F.substring(lg.dt, 9, 2)).alias("event_name"),
        F.col("dt").alias("last_update"),
    ).distinct()


def name_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary versions that take effect at a time: some days only, each id at its own hour."""
    versions = dictionary(spark, sf_dir)
    day, number = F.substring("last_update", 9, 2).cast("int"), F.col("event_id").cast("int")
    valid_from = F.expr("CAST(last_update AS timestamp_ntz) + make_dt_interval(0, CAST(event_id AS int))")
    return versions.where((day + number) % 3 == 1).select("event_id", F.col("event_name").alias("type_name"), valid_from.alias("valid_from"))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with ``batch``, the day on which a row arrives; some rows arrive one to three days late."""
    delay = F.when(F.col("seq") % 7 == 0, 1 + F.col("seq") % 3).otherwise(0)
    return log(spark, sf_dir).withColumn("batch", F.unix_date(F.col("ts").cast("date")).cast("long") + delay)
