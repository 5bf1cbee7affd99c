"""Keyed event-time state for the streaming forms (ST2/ST3, W6).

One state function covers both: ``numbered`` gives every row its
running number within its key, in (event time, arrival) order, carrying the
last number across micro-batches. The state is a single long per key and is
dropped by an event-time timeout once the watermark passes the key's expiry
(the end of its day or window), so it stays bounded.

* click cap: number <= cap passes, number = cap + 1 is the warning;
* running UV: number = 1 per (window, offset), then numbered per window.

Rows of one key within one micro-batch meet in one task (that is what keyed
state is); the batch size is capped by the source's per-trigger limit.

The functions here run in Python workers, which must be able to import this
package: install it on the cluster or ship it with ``--py-files``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from clickflow.session import workers_find_package

NUMBER_COL = "_n"


def _numbering(order_cols: list[str], expire_col: str):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        frames = [p for p in pdfs if len(p)]
        if not frames:
            return
        pdf = pd.concat(frames, ignore_index=True).sort_values(order_cols, kind="stable")
        start = state.get[0] if state.exists else 0
        pdf[NUMBER_COL] = range(start + 1, start + 1 + len(pdf))
        state.update((start + len(pdf),))
        expire = int(pdf[expire_col].max())
        state.setTimeoutTimestamp(max(expire, state.getCurrentWatermarkMs() + 1))
        yield pdf
    return fn


def numbered(df: DataFrame, keys: list[str], order_cols: list[str],
             expire_col: str) -> DataFrame:
    """Append ``_n``: the row's running number within ``keys``.

    ``df`` must carry a watermark; ``expire_col`` holds, per row, the event
    time (epoch ms) after which its key can never get another row.
    """
    workers_find_package(df.sparkSession)
    out = T.StructType(df.schema.fields + [T.StructField(NUMBER_COL, T.LongType())])
    state = T.StructType([T.StructField("n", T.LongType())])
    return df.groupBy(*keys).applyInPandasWithState(
        _numbering(order_cols, expire_col), out, state, "append",
        GroupStateTimeout.EventTimeTimeout)


class _Numbering(StatefulProcessor):
    """``numbered`` as a transformWithState processor: one long per key, and
    an event-time timer at the key's expiry that clears it."""

    def __init__(self, order_cols: list[str], expire_col: str):
        self.order_cols, self.expire_col = order_cols, expire_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.n = handle.getValueState("n", T.StructType([T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [p for p in rows if len(p)]
        if not frames:
            return
        pdf = pd.concat(frames, ignore_index=True).sort_values(self.order_cols, kind="stable")
        start = self.n.get()[0] if self.n.exists() else 0
        pdf[NUMBER_COL] = range(start + 1, start + 1 + len(pdf))
        self.n.update((start + len(pdf),))
        expire = int(pdf[self.expire_col].max())
        if expire > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(expire)
        yield pdf

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.n.clear()
        return iter(())

    def close(self) -> None:
        pass


def numbered_chainable(df: DataFrame, keys: list[str], order_cols: list[str],
                       expire_col: str, event_time_col: str = "ts") -> DataFrame:
    """``numbered`` whose output keeps ``event_time_col`` as its event time, so
    windowed aggregations (or a second numbering) can follow in the same
    query (transformWithState; needs the RocksDB state store)."""
    workers_find_package(df.sparkSession)
    out = T.StructType(df.schema.fields + [T.StructField(NUMBER_COL, T.LongType())])
    return df.groupBy(*keys).transformWithStateInPandas(
        _Numbering(order_cols, expire_col), out, "append", "EventTime",
        eventTimeColumnName=event_time_col)
