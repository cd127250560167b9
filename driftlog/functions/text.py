"""Small scalar helpers written as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_drop_trailing(text: Column | str, sep: str = ",") -> Column:
    """``String.split(sep)`` as Java does it: trailing empty fields are dropped.

    Spark's ``split`` keeps trailing empties, so strip a run of separators at
    the very end first (a line end after them is a field like any other).
    ``sep`` is a literal single character.
    """
    esc = "\\" + sep if sep in r".^$*+?()[]{}|\/" else sep
    return F.split(F.regexp_replace(_c(text), f"({esc})+\\z", ""), esc)


def date_part(time_text: Column | str) -> Column:
    """Text before the first blank (``time.split(" ")[0]``)."""
    return F.substring_index(_c(time_text), " ", 1)


def null_or_empty(c: Column | str) -> Column:
    c = _c(c)
    return c.isNull() | (c == F.lit(""))


def empty_to_null(c: Column | str) -> Column:
    c = _c(c)
    return F.when(c != F.lit(""), c)


def hour_folder(ts: Column | str, zone: str = "Asia/Shanghai",
                pattern: str = "yyyy-MM-dd--HH") -> Column:
    """Hourly folder name of a UTC instant in ``zone``.

    Works for ``timestamp`` and ``timestamp_ntz`` input without relying on
    the session time zone: the value is read as UTC wall time.
    """
    ts = _c(ts)
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))
    return F.date_format(local, pattern)


def json_text_field(doc: Column | str, path: str) -> Column:
    """Scalar at a JSON path; objects/arrays and empty text become null."""
    v = F.get_json_object(_c(doc), path)
    return F.when(~(v.startswith("[") | v.startswith("{") | (v == F.lit(""))), v)
