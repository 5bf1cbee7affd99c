"""Streaming forms of the operators (W1-W6, ST1-ST6).

Each function takes a streaming DataFrame of parsed input rows and returns a
streaming DataFrame; start it with ``clickflow.streaming.run.start``. Event
time is ``ts`` (a TIMESTAMP built from ``ts_sec`` / ``ts_ms``) with a
watermark; windows are Spark's epoch-aligned ``window()``; results carry
``window_end`` as epoch ms like the batch forms, so stream and batch outputs
compare directly.

A row is late, and dropped and counted (``run.late_rows``), once it is older
than the newest event time by more than ``delay``. Windowed counts default to
the reference's ascending time; forms that keep state per day or hour default
to twice that length, so a row is late only well after its day or hour is over.

Output modes: windowed counts use ``append`` (one final row per window once
the watermark passes its end); ``page_window_counts_stream`` uses
``update`` to reproduce the allowed-lateness re-fires.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.functions.hashing import DEFAULT_MASK
from clickflow.operators import behavior as bh
from clickflow.operators import dau
from clickflow.operators.ads import CLICK_COLUMNS, warning_text
from clickflow.operators.marketing import not_uninstall
from clickflow.streaming.keyed import final_first_offsets_stream, ring_sums, top_k_windows
from clickflow.streaming.state import NUMBER_COL, numbered, numbered_chainable

DAY_MS = 86_400_000


# Twice the key's length: a row is taken until the day (hour) after its own
# is over.
DAY_DELAY = "2 days"
HOUR_DELAY = "2 hours"
DEVICE_DELAY = "3 days"


def with_event_time(df: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """``ts`` from ``ts_sec`` (or ``ts_ms``) plus a watermark.
    ``'0 seconds'`` is the ascending-time extractor (max ts - 1 ms in the
    reference); ``'1 second'`` the bounded-disorder one."""
    ts = (F.timestamp_seconds("ts_sec") if "ts_sec" in df.columns
          else F.timestamp_millis("ts_ms"))
    return df.withColumn("ts", ts).withWatermark("ts", delay)


def _end(w: str = "w") -> F.Column:
    return F.unix_millis(F.col(f"{w}.end")).alias("window_end")


# ---- behaviour ---------------------------------------------------------------

def item_window_counts_stream(behaviors: DataFrame, size: str = "1 hour",
                              slide: str = "5 minutes", delay: str = "0 seconds") -> DataFrame:
    """A1 streaming: item_id, window_end, count (append)."""
    pv = with_event_time(bh.page_views(behaviors), delay)
    return (pv.groupBy(F.window("ts", size, slide).alias("w"), "item_id").count()
            .select("item_id", _end(), "count"))


def hot_items_stream(behaviors: DataFrame, k: int = 5, size: str = "1 hour",
                     slide: str = "5 minutes", delay: str = "0 seconds") -> DataFrame:
    """T1 streaming as one plan (append): window_end, rank, item_id, count.
    The counts' aggregation is followed by two steps that keep ``k`` rows per
    window each."""
    pv = with_event_time(bh.page_views(behaviors), delay)
    counts = pv.groupBy(F.window("ts", size, slide).alias("w"), "item_id").count()
    return top_k_windows(counts.select("item_id", _end(), "count", F.window_time("w").alias("ts")),
                         "item_id", k)


def page_window_counts_stream(logs: DataFrame, size: str = "20 minutes",
                              slide: str = "5 minutes",
                              delay: str = "61 seconds") -> DataFrame:
    """A2 + W2 + W4 streaming: 1 s disorder plus 1 min allowed lateness is a
    61 s watermark delay; run in ``update`` mode so a late row re-emits its
    window's new count (the sink keeps the last count per url and window)."""
    g = with_event_time(bh.get_requests(logs), delay)
    return (g.groupBy(F.window("ts", size, slide).alias("w"), "url").count()
            .select("url", _end(), "count"))


def pv_hourly_stream(behaviors: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """A3 streaming: url 'pv', window_end, count."""
    pv = with_event_time(bh.page_views(behaviors), delay)
    return (pv.groupBy(F.window("ts", "1 hour").alias("w")).count()
            .select(F.lit("pv").alias("url"), _end(), "count"))


def pv_hourly_salted_stream(behaviors: DataFrame, buckets: int = 100,
                            delay: str = "0 seconds") -> DataFrame:
    """A3 + ST5 streaming: salted partial counts per (window, salt), then a
    chained aggregation sums them per window (both in append mode)."""
    pv = with_event_time(bh.page_views(behaviors), delay)
    salt = F.pmod(F.xxhash64("user_id", "item_id", "ts_sec", "seq"), F.lit(buckets))
    part = pv.groupBy(F.window("ts", "1 hour").alias("w"), salt.alias("salt")).count()
    return (part.groupBy("w").agg(F.sum("count").alias("count"))
            .select(F.lit("pv").alias("url"), _end(), "count"))


def _uv_stream(pv: DataFrame, id_col: str) -> DataFrame:
    # a distinct aggregate is not allowed on a stream: dedup by (window, id)
    # in one aggregation, count per window in a chained one
    per = pv.groupBy(F.window("ts", "1 hour").alias("w"), id_col).count()
    return (per.groupBy("w").agg(F.count(F.lit(1)).alias("count"))
            .select(F.lit("uv").alias("url"), _end(), "count"))


def uv_hourly_stream(behaviors: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """A4 streaming."""
    return _uv_stream(with_event_time(bh.page_views_exact(behaviors), delay), "user_id")


def uv_hourly_bitmap_stream(behaviors: DataFrame, mask: int = DEFAULT_MASK,
                            delay: str = "0 seconds") -> DataFrame:
    """A5 streaming: distinct bitmap offsets per hour."""
    pv = with_event_time(bh.with_offset(bh.page_views_exact(behaviors), mask), delay)
    return _uv_stream(pv, "offset")


def uv_hourly_approx_stream(behaviors: DataFrame, rsd: float = 0.05,
                            delay: str = "0 seconds") -> DataFrame:
    """A5, Spark-native: an HLL++ sketch per hour (one aggregation)."""
    pv = with_event_time(bh.page_views_exact(behaviors), delay)
    return (pv.groupBy(F.window("ts", "1 hour").alias("w"))
            .agg(F.approx_count_distinct("user_id", rsd).alias("count"))
            .select(F.lit("uv").alias("url"), _end(), "count"))


def uv_first_offsets_stream(behaviors: DataFrame, mask: int = DEFAULT_MASK,
                            delay: str = HOUR_DELAY) -> DataFrame:
    """W6, stage 1: the first row to arrive of each (hour, bitmap offset) --
    the rows that set a new bit; with several in one batch, any of them. Write
    it to a sink; stage 2 reads it back."""
    pv = bh.with_offset(bh.page_views_exact(behaviors), mask)
    pv = with_event_time(pv.withColumn("window_end", bh.tumbling_end(F.col("ts_sec") * 1000,
                                                                      bh.HOUR_MS)), delay)
    return (pv.select("window_end", "offset", "user_id", "ts_sec", "seq", "ts")
            .dropDuplicatesWithinWatermark(["window_end", "offset"]))


def uv_running_stream(first_offsets: DataFrame, delay: str = HOUR_DELAY) -> DataFrame:
    """W6, stage 2: the running UV per hour over stage 1's rows:
    url 'uv', window_end, count, user_id, ts_sec. Rows are numbered batch by
    batch, within a batch by (ts_sec, seq). An hour's new visitors of one
    batch meet in one task: they are bounded by the batch size, which the
    source's per-trigger limit sets."""
    f = first_offsets.withWatermark("ts", delay)
    n = numbered(f, ["window_end"], ["ts_sec", "seq"], "window_end")
    return n.select(F.lit("uv").alias("url"), "window_end", F.col(NUMBER_COL).alias("count"),
                    "user_id", "ts_sec")


def uv_final_firsts_stream(behaviors: DataFrame, mask: int = DEFAULT_MASK,
                           delay: str = "0 seconds") -> DataFrame:
    """W6, stage 1 of the exact form: window_end, offset, user_id, ts_sec, seq
    of the rows that set a new bit, each once the watermark reaches it, so
    rows up to ``delay`` out of order are ranked right. A batch gives out whole
    seconds; ``apps.uv_running_app`` numbers them."""
    pv = bh.with_offset(bh.page_views_exact(behaviors), mask)
    pv = with_event_time(pv.withColumn("window_end", bh.tumbling_end(F.col("ts_sec") * 1000,
                                                                      bh.HOUR_MS)), delay)
    return final_first_offsets_stream(
        pv.select("window_end", "offset", "user_id", "ts_sec", "seq", "ts"))


# ---- ads and marketing ---------------------------------------------------------

def ad_click_outcomes_stream(clicks: DataFrame, cap: int = 100,
                             delay: str = DAY_DELAY) -> DataFrame:
    """ST2 + ST3 streaming: every click numbered within (user, ad, UTC day);
    ``outcome`` 'pass' (<= cap), 'warn' (cap + 1, once), or 'drop'. Keyed
    state expires when the watermark passes the day's end. Split the two
    outputs with ``split_ad_outcomes`` (e.g. inside ``foreachBatch``)."""
    c = with_event_time(clicks.select(*CLICK_COLUMNS), delay)
    c = c.withColumn("day", F.floor(F.col("ts_sec") / 86400).cast("long"))
    c = c.withColumn("_expire", (F.col("day") + 1) * DAY_MS)
    n = numbered(c, ["user_id", "ad_id", "day"], ["ts_sec", "seq"], "_expire")
    k = F.col(NUMBER_COL)
    outcome = (F.when(k <= cap, F.lit("pass")).when(k == cap + 1, F.lit("warn"))
               .otherwise(F.lit("drop")))
    return n.select(*CLICK_COLUMNS, "ts", outcome.alias("outcome"),
                    F.lit(warning_text(cap)).alias("warning"))


def ad_clicks_by_province_one_query(clicks: DataFrame, cap: int = 100,
                                     size: str = "1 hour", slide: str = "5 minutes",
                                     delay: str = DAY_DELAY) -> DataFrame:
    """ST2 + A6 in one streaming query: the cap's numbering keeps ``ts`` as
    its event time (transformWithState), so the province windows follow
    directly instead of running as a second query over a sink. The windows
    close ``delay`` after their end, as the cap accepts clicks until then."""
    c = with_event_time(clicks.select(*CLICK_COLUMNS), delay)
    c = c.withColumn("day", F.floor(F.col("ts_sec") / 86400).cast("long"))
    # (transformWithState renames input columns that start with "_")
    c = c.withColumn("expire_ms", (F.col("day") + 1) * DAY_MS)
    n = numbered_chainable(c, ["user_id", "ad_id", "day"], ["ts_sec", "seq"], "expire_ms")
    passed = n.where(F.col(NUMBER_COL) <= cap)
    return (passed.groupBy(F.window("ts", size, slide).alias("w"), "province").count()
            .select("province", _end(), "count"))


def uv_running_one_query(behaviors: DataFrame, mask: int = DEFAULT_MASK,
                         delay: str = HOUR_DELAY) -> DataFrame:
    """W6 in one streaming query: first row per (hour, offset), then the
    running number per hour, as two chained transformWithState operators."""
    pv = bh.with_offset(bh.page_views_exact(behaviors), mask)
    pv = with_event_time(pv.withColumn("window_end", bh.tumbling_end(F.col("ts_sec") * 1000,
                                                                      bh.HOUR_MS)), delay)
    pv = pv.select("window_end", "offset", "user_id", "ts_sec", "seq", "ts")
    first = numbered_chainable(pv, ["window_end", "offset"], ["ts_sec", "seq"], "window_end")
    first = first.where(F.col(NUMBER_COL) == 1).drop(NUMBER_COL)
    n = numbered_chainable(first, ["window_end"], ["ts_sec", "seq"], "window_end")
    return n.select(F.lit("uv").alias("url"), "window_end", F.col(NUMBER_COL).alias("count"),
                    "user_id", "ts_sec")


def split_ad_outcomes(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passed clicks, warnings) from ``ad_click_outcomes_stream`` rows."""
    passed = outcomes.where(F.col("outcome") == "pass").select(*CLICK_COLUMNS)
    warns = outcomes.where(F.col("outcome") == "warn").select(
        "user_id", "ad_id", "warning", "ts_sec")
    return passed, warns


def ad_clicks_by_province_stream(passed: DataFrame, size: str = "1 hour",
                                 slide: str = "5 minutes", delay: str = DAY_DELAY) -> DataFrame:
    """A6 streaming over the passed clicks (read back from their sink); they
    come as late as the cap lets them."""
    p = with_event_time(passed, delay)
    return (p.groupBy(F.window("ts", size, slide).alias("w"), "province").count()
            .select("province", _end(), "count"))


def marketing_by_channel_stream(events: DataFrame, size: str = "1 hour",
                                slide: str = "5 seconds",
                                delay: str = "0 seconds") -> DataFrame:
    """A7 streaming: 5 s pane counts, then a chained sliding sum of panes
    (each pane row, not each event, is expanded to its 720 windows)."""
    e = with_event_time(not_uninstall(events), delay)
    # ``window_time`` (the pane's last instant) keeps the event-time marker;
    # panes align with the slide, so it lies in exactly the pane's windows
    panes = (e.groupBy(F.window("ts", slide).alias("p"), "channel", "behavior").count()
             .select(F.window_time("p").alias("pane"), "channel", "behavior", "count"))
    return (panes.groupBy(F.window("pane", size, slide).alias("w"), "channel", "behavior")
            .agg(F.sum("count").alias("count"))
            .select("channel", "behavior", _end(), "count"))


def marketing_ring_stream(events: DataFrame, size_ms: int = bh.HOUR_MS, slide_ms: int = 5_000,
                          delay: str = "0 seconds") -> DataFrame:
    """A7 streaming without a fan-out: 5 s pane counts, then a ring of the
    window's panes per (channel, behavior) whose running sum gives each window
    end's count. A key without an event in its window gives no rows and keeps
    no state."""
    e = with_event_time(not_uninstall(events), delay)
    panes = (e.groupBy(F.window("ts", f"{slide_ms} milliseconds").alias("p"), "channel", "behavior")
             .count().select("channel", "behavior", "count", F.window_time("p").alias("pane_time"),
                             (F.unix_millis("p.start") / slide_ms).cast("long").alias("pane")))
    return ring_sums(panes, ["channel", "behavior"], size_ms, slide_ms)


# ---- app logs ------------------------------------------------------------------

def dau_first_stream(logs: DataFrame, delay: str = DEVICE_DELAY) -> DataFrame:
    """ST1 streaming: the first start log to arrive per (UTC day, device)
    across batches; with several in one batch, any of them. A key is kept for
    ``delay`` (at least the day, or a device could count twice); older logs
    are dropped and counted."""
    d = dau.decoded_starts(logs)
    d = with_event_time(d.withColumnRenamed("ts", "ts_ms"), delay)
    return d.dropDuplicatesWithinWatermark(["dt", "mid"]).select(
        "dt", "mid", "uid", "ar", "ch", "vc", F.col("ts_ms").alias("ts"), "seq")
