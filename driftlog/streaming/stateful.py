"""Per-row running counts on a stream (one output row per input row).

The native aggregation in ``jobs.scoreboard_stream`` emits one update per
key and micro-batch, which is enough for the scoreboard.  When every row's
running value is wanted (the keyed running sum's own output), state per key
is kept with ``applyInPandasWithState``: ``(count so far, first date)``.

Of a key's rows of a micro-batch only the order numbers are held together (to
sort them); rows leave in frames of ``FRAME_ROWS``, so a hot key never stands in
one frame.  The trigger bounds the numbers held (``maxOffsetsPerTrigger`` /
``maxFilesPerTrigger``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from driftlog.operators.metrics import USER_KEY

FRAME_ROWS = 100_000

_STATE = T.StructType([T.StructField("cnt", T.LongType()), T.StructField("first_dt", T.StringType())])


def running_count_rows(df: DataFrame, keys: tuple[str, ...] = USER_KEY, seq: str = "seq",
                       dt: str = "dt", idle_timeout_ms: int | None = None) -> DataFrame:
    """Streaming ``running_count``: ``seq, *keys, first_dt, cnt`` for every input row.

    Rows of a key are numbered in ``seq`` order inside each micro-batch and
    continue from the stored count (``seq`` must be a sortable scalar).
    ``idle_timeout_ms`` drops the state of keys idle that long (processing
    time); the reference keeps keys forever, which is the default here.
    """
    keys = tuple(keys)
    out_schema = T.StructType([df.schema[seq], *[df.schema[k] for k in keys],
                               T.StructField("first_dt", T.StringType()), T.StructField("cnt", T.LongType())])
    out_cols = [seq, *keys, "first_dt", "cnt"]

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        count, first = state.get if state.exists else (0, None)
        orders, least = [], None
        for pdf in batches:
            if not len(pdf):
                continue
            orders.append(pdf[seq].to_numpy())
            at = int(np.argmin(orders[-1]))
            if not count and (least is None or orders[-1][at] < least):
                least, first = orders[-1][at], pdf[dt].iloc[at]
        if not orders:
            return
        order = np.sort(np.concatenate(orders), kind="stable")
        for start in range(0, len(order), FRAME_ROWS):
            part = order[start:start + FRAME_ROWS]
            n = count + start
            yield pd.DataFrame({seq: part, **dict(zip(keys, key)), "first_dt": first,
                                "cnt": np.arange(n + 1, n + len(part) + 1, dtype="int64")})[out_cols]
        state.update((int(count + len(order)), first))
        if idle_timeout_ms:
            state.setTimeoutDuration(idle_timeout_ms)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_timeout_ms else GroupStateTimeout.NoTimeout
    return (df.select(seq, *keys, dt).groupBy(*keys)
            .applyInPandasWithState(step, out_schema, _STATE, "append", timeout))
