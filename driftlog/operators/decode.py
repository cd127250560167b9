"""Text decoders and encoders for log lines (CSV and JSON).

Each decoder has an ``on_corrupt`` policy:

* ``"drop"``  -- bad records disappear (the reference's behaviour for CSV and JSON);
* ``"error"`` -- the task fails on the first bad record (``raise_error``);
* ``"flag"``  -- every record is kept and a boolean ``_corrupt`` column tells them apart,
  so bad records can be reported or routed to a dead-letter sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlog.functions.text import null_or_empty, split_drop_trailing
from driftlog.schemas import CSV_FIELDS, JSON_TEXT

_POLICIES = ("drop", "error", "flag")


def _apply_policy(df: DataFrame, bad: Column, on_corrupt: str, what: str) -> DataFrame:
    if on_corrupt not in _POLICIES:
        raise ValueError(f"on_corrupt must be one of {_POLICIES}, got {on_corrupt!r}")
    if on_corrupt == "drop":
        return df.where(~bad)
    if on_corrupt == "error":
        return df.where(F.when(bad, F.raise_error(F.lit(f"corrupt {what} record"))).isNull())
    return df.withColumn("_corrupt", bad)


def _evaluate_once(df: DataFrame, keep: tuple[str, ...], expr: Column, name: str) -> DataFrame:
    """Project ``expr`` as column ``name`` so that it is computed once per row.

    A plain alias would be inlined by the optimizer into every later
    reference -- including filters pushed below the projection -- and an
    expensive parse would run several times per row.  A generator output
    cannot be inlined or have filters pushed beneath it.
    """
    return df.select(*keep, F.inline(F.array(F.struct(expr.alias(name)))))


def parse_csv_events(df: DataFrame, line_col: str = "line", on_corrupt: str = "drop",
                     keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """``uid,eventName,time,eventTypeId,province`` lines -> typed rows with ``cnt = 1``.

    Lines with fewer than five fields after Java-style splitting (trailing
    empty fields dropped) are corrupt; extra fields are ignored, nothing is
    trimmed.
    """
    parts = split_drop_trailing(F.col(line_col), ",")
    staged = _evaluate_once(df, keep, parts, "_f")
    bad = F.col("_f").isNull() | (F.size("_f") < 5)
    staged = _apply_policy(staged, bad, on_corrupt, "CSV")
    fields = [F.get(F.col("_f"), i).alias(name) for i, name in enumerate(CSV_FIELDS)]
    extra = ["_corrupt"] if on_corrupt == "flag" else []
    return staged.select(*keep, *fields, F.lit(1).alias("cnt"), *extra)


#: Field of the end mark behind a line.
LINE_END = "_end_of_line"


def parse_json_events(df: DataFrame, line_col: str = "line", on_corrupt: str = "drop",
                      keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """JSON log lines -> ``uid, time, event_type, jd, wd, province, city, area``.

    Numbers are read as text and converted with ``try_cast`` so a quoted
    number is accepted; text that is not a number marks the record corrupt.
    Missing coordinates, and coordinates given as empty text, become 0.0
    (primitive defaults).  Empty, null, non-object and unparseable lines are
    corrupt, and so is a line with anything but blanks after its object: a
    parser stops at the end of the first object, so the line is parsed as the first
    of the two elements of ``[line, <end mark>]``.  Whatever follows the object
    breaks the array or moves or hides the end mark.
    """
    marked = T.ArrayType(T.StructType([*JSON_TEXT.fields, T.StructField(LINE_END, T.IntegerType())]))
    parsed = F.from_json(F.concat(F.lit("["), F.col(line_col), F.lit(f',{{"{LINE_END}":1}}]')), marked)
    staged = _evaluate_once(df, keep, parsed, "_a")
    whole = (F.size("_a") == 2) & (F.get("_a", F.lit(1))[LINE_END] == 1)
    staged = staged.select(*keep, F.when(whole, F.get("_a", F.lit(0))).alias("_j"))
    j = F.col("_j")
    jd_num = F.expr("try_cast(_j.jd AS DOUBLE)")
    wd_num = F.expr("try_cast(_j.wd AS DOUBLE)")
    bad = (j.isNull()
           | (~null_or_empty(j["jd"]) & jd_num.isNull())
           | (~null_or_empty(j["wd"]) & wd_num.isNull()))
    staged = staged.select("*", jd_num.alias("_jd"), wd_num.alias("_wd"))
    staged = _apply_policy(staged, bad, on_corrupt, "JSON")
    extra = ["_corrupt"] if on_corrupt == "flag" else []
    return staged.select(
        *keep,
        j["uid"].alias("uid"), j["time"].alias("time"), j["eventType"].alias("event_type"),
        F.coalesce(F.col("_jd"), F.lit(0.0)).alias("jd"),
        F.coalesce(F.col("_wd"), F.lit(0.0)).alias("wd"),
        j["province"].alias("province"), j["city"].alias("city"), j["area"].alias("area"),
        *extra,
    )


def encode_json_events(df: DataFrame, out_col: str = "json",
                       keep: tuple[str, ...] = ("seq",),
                       fields: dict[str, str] | None = None) -> DataFrame:
    """Row -> JSON text with keys in alphabetical order and null fields left out.

    ``fields`` maps JSON key -> column; the default is the event-log bean
    (area, city, eventType, jd, province, time, uid, wd).
    """
    fields = fields or {"area": "area", "city": "city", "eventType": "event_type", "jd": "jd",
                        "province": "province", "time": "time", "uid": "uid", "wd": "wd"}
    cols = [F.col(src).alias(key) for key, src in sorted(fields.items())]
    return df.select(*keep, F.to_json(F.struct(*cols)).alias(out_col))
