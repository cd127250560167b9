"""The activity-count job as one batch plan (the reference's P2, end to end)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlog.functions.text import date_part
from driftlog.operators import decode, dictionary, metrics
from driftlog.plans import derived


def scoreboard_from_lines(lines: DataFrame, names: DataFrame, on_missing: str = "null") -> DataFrame:
    """CSV lines + resolved dictionary -> scoreboard ``(board_key, event_type, value)``."""
    rows = decode.parse_csv_events(lines)
    named = dictionary.lookup_event_names(rows, names, on_missing=on_missing)
    keyed = named.select("seq", "uid", "event_name", F.col("event_type_name").alias("event_type"),
                         date_part("time").alias("dt"))
    return metrics.activity_scoreboard(keyed)


def scoreboard_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = dictionary.latest_names(derived.dictionary(spark, sf_dir))
    return scoreboard_from_lines(derived.csv_lines(spark, sf_dir), names)
