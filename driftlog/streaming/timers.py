"""Keyed state with timers: running counts that expire, and events that wait for their name.

Both use ``transformWithState`` (RocksDB state store).  Rows of a key are taken
in event-time order within a micro-batch; event-time timers drop what the
watermark has passed, so state is bounded by what is still open.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from driftlog.functions.clock import event_time

MILLIS = 1000
#: A timer may fire later by this part of the span it waits for, so that keys have few timers.
COARSE = 64


def _timer(at: int, span: int) -> int:
    """The millisecond of a timer that fires behind ``at`` (microseconds), rounded up to a part of ``span``."""
    step = max(1, span // COARSE // MILLIS)
    return (at // MILLIS // step + 1) * step


def _held(rows: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame | None:
    frames = [f for f in rows if len(f)]
    return pd.concat(frames, ignore_index=True).sort_values(by, kind="stable") if frames else None


class _RunningCounts(StatefulProcessor):
    """Value state per bucket of keys: ``(key, item) -> (count, time of its last row)``, and the one timer that is pending.

    A bucket costs a few calls from Python to the JVM per batch (state read, state
    written, a timer if none is pending), whatever the number of its keys and items.
    """

    def __init__(self, idle: int, width: int) -> None:
        self.idle = idle
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        texts, numbers = T.ArrayType(T.StringType()), T.ArrayType(T.LongType())
        self.counts = handle.getValueState("counts", T.StructType([
            T.StructField("keys", texts), T.StructField("items", texts), T.StructField("cnts", numbers),
            T.StructField("lasts", numbers), T.StructField("timer", T.LongType())]))

    def _read(self) -> tuple[dict, int | None]:
        held = self.counts.get()
        if held is None:
            return {}, None
        keys, items, cnts, lasts, timer = held
        return dict(zip(zip(keys, items), zip(cnts, lasts))), timer

    def _write(self, known: dict, timer: int | None, passed: int = 0) -> None:
        if timer is None:
            timer = max(_timer(min(last for _, last in known.values()) + self.idle, self.idle), passed)
            self.handle.registerTimer(timer)
        self.counts.update(([k for k, _ in known], [i for _, i in known], [c for c, _ in known.values()], [t for _, t in known.values()], timer))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _held(rows, ["us", "no_seq", "seq"])
        if frame is None:
            return
        known, timer = self._read()
        out = []
        for of, at in zip(zip(frame["key"].tolist(), frame["item"].tolist()), frame["us"].tolist()):
            count, last = known.get(of, (0, None))
            known[of] = count, _ = (1, at) if last is None else (1 if at - last > self.idle else count + 1, max(at, last))
            out.append(count)
        self._write(known, timer)
        if frame["no_seq"].any():
            frame["seq"] = frame["seq"].convert_dtypes().mask(frame["no_seq"])
        for i in range(self.width):
            if int(key[0]) >> i & 1:
                frame[f"key{i}"] = None
        yield frame.drop(columns=["bucket", "key", "no_seq", "time", "us"], errors="ignore").assign(cnt=out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        left = {of: (count, last) for of, (count, last) in self._read()[0].items() if last + self.idle >= passed * MILLIS}
        if left:
            self._write(left, None, passed + 1)
        else:
            self.counts.clear()
        return iter([])

    def close(self) -> None:
        pass


def expiring_counts_stream(df: DataFrame, keys: tuple[str, ...], item: str, seq: str, time: str, idle: int, delay: int,
                           buckets: int = 256) -> DataFrame:
    """Every row with the running count of its ``item`` within its key; a count starts anew after ``idle`` microseconds without rows.

    ``seq, keys, item, cnt`` per input row.  State that the watermark (``delay``
    behind the greatest event time) has passed by ``idle`` is dropped by timers;
    rows behind the watermark are dropped by Spark.  Keys are dealt into ``buckets``
    by their hash and the counts of a bucket are one state value: so many buckets
    that each has some hundred keys, and always as many for one checkpoint.
    """
    text = F.to_json(F.struct(*[F.col(k).cast("string").alias(f"key{i}") for i, k in enumerate(keys)]))
    # pandas has no nulls among whole numbers, so these are 0: a bucket's keys are null in the same columns, which its number tells
    def filled(c: str):
        return F.coalesce(F.col(c), F.lit(0)).cast(df.schema[c].dataType) if isinstance(df.schema[c].dataType, T.IntegralType) else F.col(c)

    named = [filled(k).alias(f"key{i}") for i, k in enumerate(keys)]
    nulls = sum((F.col(k).isNull().cast("long") * F.lit(1 << i) for i, k in enumerate(keys)), F.lit(0).cast("long"))
    rows = df.select((F.pmod(F.xxhash64(*keys), F.lit(buckets)) * F.lit(1 << len(keys)) + nulls).alias("bucket"), text.alias("key"),
                     filled(seq).alias("seq"), F.col(seq).isNull().alias("no_seq"), *named, F.col(item).cast("string").alias("item"),
                     event_time(F.col(time), df.schema[time].dataType).alias("time"))
    rows = rows.withWatermark("time", f"{delay} microseconds").withColumn("us", F.unix_micros("time"))
    schema = T.StructType([T.StructField("seq", df.schema[seq].dataType), *[T.StructField(f"key{i}", df.schema[k].dataType) for i, k in enumerate(keys)],
                           T.StructField("item", T.StringType()), T.StructField("cnt", T.LongType())])
    out = rows.groupBy("bucket").transformWithStateInPandas(_RunningCounts(idle, len(keys)), schema, "Append", "EventTime")
    return out.select(F.col("seq").alias(seq), *[F.col(f"key{i}").alias(k) for i, k in enumerate(keys)], F.col("item").alias(item), "cnt")


class _Waiting(StatefulProcessor):
    """Value state: the key's latest name, its time and the time of the first; list state: events that wait for one."""

    def __init__(self, wait: int) -> None:
        self.wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.name = handle.getValueState("name", T.StructType([
            T.StructField("name", T.StringType()), T.StructField("at", T.LongType()), T.StructField("first", T.LongType())]))
        self.events = handle.getListState("events", T.StructType([T.StructField("seq", T.LongType()), T.StructField("at", T.LongType())]))

    def _rows(self, key, events, name) -> Iterator[pd.DataFrame]:
        if events:
            yield pd.DataFrame({"seq": [e[0] for e in events], "key": key[0], "name": pd.array([name] * len(events), "string")})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _held(rows, ["us"])
        if frame is None:
            return
        names = frame[frame["side"] == 0]
        held = self.name.get() if self.name.exists() else None
        if len(names):
            latest = names.sort_values(["us", "name_text"], kind="stable").iloc[-1]
            text, at, first = held or (None, -1, int(names["us"].min()))
            if held is None or int(latest["us"]) >= at:
                text, at = latest["name_text"], int(latest["us"])
            held = (text, at, min(first, int(names["us"].min())))
            self.name.update(held)
        fresh = [(int(s), int(u)) for s, u in zip(frame["event_seq"][frame["side"] == 1], frame["us"][frame["side"] == 1])]
        waiting = [tuple(e) for e in self.events.get()] if len(names) and self.events.exists() else []
        in_time = [e for e in waiting + fresh if held is not None and held[2] <= e[1] + self.wait]
        if waiting and min(held[2] - e[1] for e in waiting) <= self.wait:
            left = [e for e in waiting if held[2] > e[1] + self.wait]
            self.events.clear()
            if left:
                self.events.put(left)
        later = [e for e in fresh if held is None or held[2] > e[1] + self.wait]
        if later:
            self.events.appendList(later)
            self.handle.registerTimer(_timer(min(at for _, at in later) + self.wait, self.wait))
        yield from self._rows(key, in_time, held and held[0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * MILLIS
        waiting = [tuple(e) for e in self.events.get()] if self.events.exists() else []
        gone = [e for e in waiting if e[1] + self.wait < passed]
        left = [e for e in waiting if e[1] + self.wait >= passed]
        if gone:
            self.events.clear()
            if left:
                self.events.put(left)
        if left:
            self.handle.registerTimer(max(_timer(min(at for _, at in left) + self.wait, self.wait), passed // MILLIS + 1))
        yield from self._rows(key, gone, None)

    def close(self) -> None:
        pass


def named_when_known_stream(events: DataFrame, names: DataFrame, key: str, seq: str, time: str, name: str, name_time: str,
                            wait: int, delay: int, parts: int = 1) -> DataFrame:
    """Two input streams: every event once, as ``seq, key, name``, with its key's name as soon as one is known.

    An event is named if the first name of its key is at most ``wait`` microseconds
    later than the event, whichever arrives first; until such a name comes it waits,
    and leaves without one when the watermark (``delay`` behind the greatest time of
    both streams) has passed its wait.  Of several names that are there when it
    leaves, that of the greatest ``name_time`` counts.  A hot key is dealt into
    ``parts`` by ``seq``; each name goes to all of them.
    """
    part = F.pmod(F.xxhash64(seq), F.lit(parts)).cast("int")
    left = events.select(F.col(key).alias("key"), part.alias("part"),
                         event_time(F.col(time), events.schema[time].dataType).alias("time_at"), F.lit(1).alias("side"),
                         F.col(seq).cast("long").alias("event_seq"), F.lit(None).cast("string").alias("name_text"))
    right = names.select(F.col(key).alias("key"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
                         event_time(F.col(name_time), names.schema[name_time].dataType).alias("time_at"), F.lit(0).alias("side"), F.lit(None).cast("long").alias("event_seq"),
                         F.col(name).alias("name_text"))
    both = left.unionByName(right).withWatermark("time_at", f"{delay} microseconds")
    both = both.withColumn("us", F.unix_micros("time_at"))
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("key", events.schema[key].dataType), T.StructField("name", T.StringType())])
    out = both.groupBy("key", "part").transformWithStateInPandas(_Waiting(wait), schema, "Append", "EventTime")
    return out.select(F.col("seq").alias(seq), F.col("key").alias(key), F.col("name").alias(name))
