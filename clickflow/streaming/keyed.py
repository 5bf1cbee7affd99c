"""Keyed state as transformWithState processors.

Each class keeps a bounded value per key in the state store, so the cost of a
micro-batch depends on its own rows and keys and not on how many batches ran
before. Rows pass as ``Row`` objects, which keeps NULLs and 64-bit numbers as
they are. A replayed batch starts from the state its predecessor left and gives
the same rows.

Python workers must be able to import this package (``--py-files``).
"""

from __future__ import annotations

import datetime
import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickflow.operators.orders import FIRST_ORDER, NOT_FIRST_ORDER
from clickflow.session import workers_find_package


class _Processor(StatefulProcessor):
    """The parts that all processors here share."""

    STATE = T.StructType()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", self.STATE)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return iter(())

    def close(self) -> None:
        pass


# ---- first orders (J1, J5) -------------------------------------------------

class _FirstOrder(_Processor):
    """One flag per user: whether an earlier batch (or the table that the state
    started from) holds an order of theirs."""

    STATE = T.StructType([T.StructField("if_consumed", T.StringType())])

    def __init__(self, columns: list[str]):
        self.columns = columns

    def _consumed(self) -> bool:
        return self.kept.exists() and (self.kept.get()[0] or "").lower() == "1"

    def handleInitialState(self, key, initialState, timerValues) -> None:
        # of several rows of a user, one that says consumed counts
        if not self._consumed():
            self.kept.update((initialState.if_consumed,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        out = Row(*self.columns, "if_first_order")

        def flagged(r: Row, flag: str) -> Row:
            return out(*(r[c] for c in self.columns), flag)

        if self._consumed():
            for r in rows:
                yield flagged(r, NOT_FIRST_ORDER)
            return
        # of the batch's orders only the earliest so far is held back
        best, held = None, []
        for r in rows:
            at = (r.create_time is not None, r.create_time or "", r.id)
            if best is None or at < best:
                for h in held:
                    if h.id != r.id:
                        yield flagged(h, NOT_FIRST_ORDER)
                held = [h for h in held if h.id == r.id] + [r]
                best = at
            elif r.id == best[2]:
                held.append(r)
            else:
                yield flagged(r, NOT_FIRST_ORDER)
        for h in held:
            yield flagged(h, FIRST_ORDER)
        self.kept.update(("1",))


def first_order_stream(orders: DataFrame, user_state: DataFrame | None = None) -> DataFrame:
    """J1 + J5 streaming: ``orders`` with ``if_first_order``, '1' for the
    earliest order (create_time, id) of the first micro-batch that has one of
    its user, unless ``user_state`` (user_id, if_consumed) says consumed; it
    seeds the state when the query first starts. Orders without a user are
    never first. An order that repeats within a batch has one create_time.

    State is one flag per user; no stored table is read again. The flags can be
    queried with ``consumed_users``."""
    spark = orders.sparkSession
    workers_find_package(spark)
    columns = [f.name for f in orders.schema if f.name != "if_first_order"]
    orders = orders.select(*columns)
    out = T.StructType([*orders.schema, T.StructField("if_first_order", T.StringType())])
    seed = None
    if user_state is not None:
        user_type = orders.schema["user_id"].dataType
        seed = (user_state.where("user_id is not null")
                .select(F.col("user_id").cast(user_type), "if_consumed").groupBy("user_id"))
    flagged = orders.where("user_id is not null").groupBy("user_id").transformWithState(
        _FirstOrder(columns), out, "append", "none", initialState=seed)
    nobody = orders.where("user_id is null").withColumn("if_first_order", F.lit(NOT_FIRST_ORDER))
    return flagged.unionByName(nobody)


def consumed_users(spark, checkpoint: str) -> DataFrame:
    """user_id, if_consumed as the last finished batch of a query over
    ``first_order_stream`` left them."""
    return (spark.read.format("statestore").option("path", checkpoint)
            .option("stateVarName", "kept").load()
            .select(F.col("key.user_id").alias("user_id"),
                    F.col("value.if_consumed").alias("if_consumed")))


# ---- late rows (W5) --------------------------------------------------------

class _LateRouter(_Processor):
    """Compares each row with the watermark its batch started with. Spark
    keeps that in the checkpoint, so it does not run back after a restart."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        out = Row(*self.columns, "late", "watermark_ms")
        for r in rows:
            yield out(*(r[c] for c in self.columns), r["closes_ms"] <= now, now)


def with_late_flag(rows: DataFrame, delay: str = "0 seconds", size_ms: int = 0,
                   slide_ms: int = 0, buckets: int = 64) -> DataFrame:
    """W5 streaming: every row of ``rows`` (with ``ts_sec`` or ``ts_ms``) and
    ``late``: whether the watermark (newest event time of the batches before
    minus ``delay``) had passed it when it came. With ``size_ms`` and
    ``slide_ms`` a row is late once the last of its sliding windows is closed,
    without them once the watermark reaches its own time. No row is dropped or
    comes out twice. ``watermark_ms`` is the watermark it was compared with.

    Rows are spread over ``buckets`` keys."""
    workers_find_package(rows.sparkSession)
    columns = rows.columns
    ms = F.col("ts_ms") if "ts_ms" in columns else F.col("ts_sec") * 1000
    closes = ms if not size_ms else F.floor(ms / slide_ms) * slide_ms + size_ms
    marked = (rows.withColumn("event_time", F.timestamp_millis(ms))
              .withWatermark("event_time", delay)
              # no event-time column reaches the operator, as it would drop
              # the late rows itself
              .select(*columns, closes.cast("long").alias("closes_ms"),
                      F.pmod(F.xxhash64(*columns), F.lit(buckets)).alias("bucket")))
    out = T.StructType([*rows.schema, T.StructField("late", T.BooleanType()),
                        T.StructField("watermark_ms", T.LongType())])
    return marked.groupBy("bucket").transformWithState(
        _LateRouter(columns), out, "append", "EventTime")


# ---- running unique visitors (W6) ------------------------------------------

class _FinalFirst(_Processor):
    """Per (hour, offset) the earliest row so far, given out once the watermark
    reaches it, as no earlier one can come then; after that a mark until the
    hour is over."""

    STATE = T.StructType([T.StructField("ts_sec", T.LongType()), T.StructField("seq", T.LongType()),
                          T.StructField("user_id", T.LongType()), T.StructField("out", T.BooleanType())])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = min((r.ts_sec, r.seq, r.user_id) for r in rows)
        old = tuple(self.kept.get()) if self.kept.exists() else None
        if old is None or (not old[3] and best < old[:3]):
            if old is not None:
                self.handle.deleteTimer(old[0] * 1000)
            self.kept.update((*best, False))
            self.handle.registerTimer(best[0] * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.kept.exists():
            return
        ts, seq, user, out = self.kept.get()
        end = key[0]
        if not out:
            yield Row("window_end", "offset", "user_id", "ts_sec", "seq")(end, key[1], user, ts, seq)
        if timerValues.getCurrentWatermarkInMs() >= end:
            self.kept.clear()
        elif not out:
            self.kept.update((ts, seq, user, True))
            self.handle.registerTimer(end)


def final_first_offsets_stream(page_views: DataFrame) -> DataFrame:
    """W6, stage 1, exact under disorder: the earliest row by (ts_sec, seq) of
    each (hour, bitmap offset), given out when the watermark reaches it. Input:
    window_end, offset, user_id, ts_sec, seq, ts (watermarked)."""
    workers_find_package(page_views.sparkSession)
    return page_views.groupBy("window_end", "offset").transformWithState(
        _FinalFirst(), "window_end long, offset long, user_id long, ts_sec long, seq long",
        "append", "EventTime")


# ---- long sliding windows (A7) ---------------------------------------------

class _Ring(_Processor):
    """The last ``size`` pane counts of a key, as a ring, and the window end up
    to which counts are out. A pane is added to the running sum when it comes
    and subtracted when it leaves the window."""

    STATE = T.StructType([T.StructField("out", T.LongType()), T.StructField("ring", T.BinaryType())])

    def __init__(self, keys: list[str], size: int, slide_ms: int):
        self.keys, self.size, self.slide_ms = keys, size, slide_ms

    def _load(self) -> tuple[int | None, np.ndarray]:
        if not self.kept.exists():
            return None, np.zeros(self.size, dtype=np.int64)
        out, ring = self.kept.get()
        return out, np.frombuffer(bytes(ring), dtype=np.int64).copy()

    def _to(self, key, out: int, ring: np.ndarray, end: int) -> Iterator[Row]:
        """Counts of the windows after ``out`` up to ``end`` while there is
        something in the ring; window e holds panes e - size ... e - 1."""
        row = Row(*self.keys, "window_end", "count")
        total = int(ring.sum())
        while out < end and total:
            out += 1
            yield row(*key, out * self.slide_ms, total)
            gone = (out - self.size) % self.size       # pane that the next window lacks
            total -= int(ring[gone])
            ring[gone] = 0

    def _keep(self, out: int, ring: np.ndarray) -> None:
        if ring.any():
            self.kept.update((out, ring.tobytes()))
            self.handle.registerTimer((out + 1) * self.slide_ms)
        else:
            self.kept.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        out, ring = self._load()
        before = out
        for pane, n in sorted((r.pane, r["count"]) for r in rows):
            if out is not None:
                yield from self._to(key, out, ring, pane)
            # windows up to ``pane`` do not hold it; empty ones have no row
            out = pane
            ring[pane % self.size] += n
        if before is not None and before != out:
            self.handle.deleteTimer((before + 1) * self.slide_ms)
        self._keep(out, ring)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        out, ring = self._load()
        if out is None:
            return
        end = timerValues.getCurrentWatermarkInMs() // self.slide_ms
        yield from self._to(key, out, ring, end)
        self._keep(max(out, end), ring)


def ring_sums(panes: DataFrame, keys: list[str], size_ms: int, slide_ms: int) -> DataFrame:
    """keys, window_end, count of every sliding window with something in it,
    from final pane counts (keys, pane number, count, pane_time watermarked).
    Each pane row is shuffled once; each key and window gives one row as soon
    as the watermark passes the window's end."""
    workers_find_package(panes.sparkSession)
    out = T.StructType([*(panes.schema[k] for k in keys), T.StructField("window_end", T.LongType()),
                        T.StructField("count", T.LongType())])
    return panes.groupBy(*keys).transformWithState(
        _Ring(keys, size_ms // slide_ms, slide_ms), out, "append", "EventTime")


# ---- top k (T1) ------------------------------------------------------------

class _Best(_Processor):
    """The ``k`` best rows of a key so far, given out once the watermark
    reaches the key's window end."""

    def __init__(self, keys: list[str], item: str, item_type: T.DataType, k: int):
        self.keys, self.item, self.k = keys, item, k
        self.STATE = T.StructType([T.StructField("counts", T.ArrayType(T.LongType())),
                                   T.StructField("items", T.ArrayType(item_type))])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        def all_rows() -> Iterator[tuple[int, object]]:
            if self.kept.exists():
                yield from zip(*self.kept.get())
            for r in rows:
                yield r["count"], r[self.item]

        best = heapq.nsmallest(self.k, ((-n, i) for n, i in all_rows()))
        self.kept.update(([-n for n, _ in best], [i for _, i in best]))
        self.handle.registerTimer(key[0])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.kept.exists():
            return
        row = Row(*self.keys, "rank", self.item, "count", "ts")
        at = datetime.datetime.fromtimestamp(key[0] / 1000, datetime.timezone.utc)
        for rank, (n, i) in enumerate(zip(*self.kept.get()), 1):
            yield row(*key, rank, i, n, at)
        self.kept.clear()


def top_k_windows(counts: DataFrame, item: str, k: int, buckets: int = 64) -> DataFrame:
    """T1 in one streaming plan: window_end, rank, item, count of the ``k``
    rows with the highest count per window (ties: smaller item first), from
    final counts (window_end, item, count, ts: the window's time, watermarked).

    First per (window, bucket of items), then per window: no task and no state
    value ever holds more than ``k`` rows of a key, and a window's counts are
    spread over ``buckets`` keys."""
    workers_find_package(counts.sparkSession)
    item_type = counts.schema[item].dataType

    def best(df: DataFrame, keys: list[str]) -> DataFrame:
        out = T.StructType([*(df.schema[c] for c in keys), T.StructField("rank", T.IntegerType()),
                            T.StructField(item, item_type), T.StructField("count", T.LongType()),
                            T.StructField("ts", T.TimestampType())])
        return df.groupBy(*keys).transformWithState(
            _Best(keys, item, item_type, k), out, "append", "EventTime", eventTimeColumnName="ts")

    bucket = F.pmod(F.xxhash64(item), F.lit(buckets)).alias("bucket")
    part = best(counts.select("window_end", item, "count", "ts", bucket), ["window_end", "bucket"])
    return best(part.drop("bucket", "rank"), ["window_end"]).select("window_end", "rank", item, "count")
