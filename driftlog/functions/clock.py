"""Event times as numbers, for bins and differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def micros(time: Column, kind: T.DataType) -> Column:
    """Microseconds since 1970 as a long; a number stays as it is.

    A timestamp without zone is read off its clock (date and time parts), so the
    result doesn't depend on the session's time zone and keeps the order.
    """
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(time)
    if isinstance(kind, T.TimestampNTZType):
        seconds = F.hour(time) * 3600 + F.minute(time) * 60
        return (F.unix_date(time.cast("date")).cast("long") * DAY + seconds.cast("long") * SECOND
                + (F.date_part(F.lit("SECOND"), time) * SECOND).cast("long"))
    if isinstance(kind, (T.IntegralType,)):
        return time.cast("long")
    raise TypeError(f"no clock in {kind.simpleString()}")


def event_time(time: Column, kind: T.DataType) -> Column:
    """A timestamp that can carry a watermark; one without zone is taken as UTC, so that ``micros`` of both agree."""
    return time if isinstance(kind, T.TimestampType) else F.timestamp_micros(micros(time, kind))


def bin_of(clock: Column, width: int) -> Column:
    """Number of the bin of ``width`` that holds a long (floor, below zero as well)."""
    return F.floor((clock - F.pmod(clock, F.lit(width))) / F.lit(width)).cast("long") if width > 1 else clock
