"""User-behaviour and web-log analytics.

Inputs are the typed rows of ``clickflow.sources``: behaviours carry
``ts_sec`` (epoch seconds) and ``seq`` (arrival order); parsed web logs carry
``ts_ms``. Every function works on a batch DataFrame; the streaming forms in
``clickflow.streaming`` reuse the filters and projections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.functions.hashing import DEFAULT_MASK, poly_hash
from clickflow.functions.text import (
    REPORT_END_LABEL, REPORT_ITEM_COUNT_LABEL, REPORT_ITEM_LABEL,
    REPORT_ITEM_RULE_BOTTOM, REPORT_PAGE_COUNT_LABEL, REPORT_PAGE_LABEL,
    REPORT_PAGE_RULE_BOTTOM, REPORT_RULE_TOP, report_line,
)
from clickflow.functions.time import java_timestamp_text
from clickflow.operators.windows import (
    rank_in_group, sliding_counts, top_k, tumbling_end,
)

# Arrival numbers are below this, so (ts_sec, seq) packs into one decimal.
SEQ_SPAN = 10 ** 18
HOUR_MS = 3_600_000
MINUTE_MS = 60_000


# ---- filters -------------------------------------------------------------

def page_views(behaviors: DataFrame) -> DataFrame:
    """page views, behaviour compared case-insensitively."""
    return behaviors.where(F.lower("behavior") == "pv")


def page_views_exact(behaviors: DataFrame) -> DataFrame:
    """page views, exact ``pv`` only (``PV`` is not a page view here)."""
    return behaviors.where(F.col("behavior") == "pv")


def get_requests(logs: DataFrame) -> DataFrame:
    """GET requests, method compared case-insensitively."""
    return logs.where(F.lower("method") == "get")


def with_ms(df: DataFrame) -> DataFrame:
    return df if "ts_ms" in df.columns else df.withColumn("ts_ms", F.col("ts_sec") * 1000)


# ---- A1 / T1 / P9: hot items ---------------------------------------------

def item_window_counts(behaviors: DataFrame, size_ms: int = HOUR_MS,
                       slide_ms: int = 5 * MINUTE_MS) -> DataFrame:
    """A1: page views per item per sliding window: item_id, window_end, count."""
    pv = with_ms(page_views(behaviors)).select("item_id", "ts_ms")
    return sliding_counts(pv, ["item_id"], "ts_ms", size_ms, slide_ms)


def hot_items(behaviors: DataFrame, k: int = 5, size_ms: int = HOUR_MS,
              slide_ms: int = 5 * MINUTE_MS) -> DataFrame:
    """Top ``k`` items per window by count (ties: smaller item first)."""
    counts = item_window_counts(behaviors, size_ms, slide_ms)
    return top_k(counts, ["window_end"], [F.desc("count"), F.asc("item_id")], k) \
        .select("window_end", "rank", "item_id", "count")


def _report(ranked: DataFrame, key: str, key_label: str, count_label: str,
            bottom: str) -> DataFrame:
    line = report_line(F.col("rank"), F.col(key), F.col("count"), key_label, count_label)
    per_window = ranked.groupBy("window_end").agg(
        F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))).alias("_l"))
    body = F.array_join(F.transform("_l", lambda r: r["line"]), "\n")
    text = F.concat(F.lit(REPORT_RULE_TOP + "\n" + REPORT_END_LABEL),
                    java_timestamp_text(F.col("window_end")), F.lit("\n"), body,
                    F.lit("\n" + bottom + "\n\n"))
    return per_window.select("window_end", text.alias("report"))


def hot_items_report(behaviors: DataFrame, k: int = 5) -> DataFrame:
    """The per-window ranking text (one row per window).

    The per-window list holds at most ``k`` rows, so collecting it is bounded.
    """
    return _report(hot_items(behaviors, k), "item_id", REPORT_ITEM_LABEL,
                   REPORT_ITEM_COUNT_LABEL, REPORT_ITEM_RULE_BOTTOM)


# ---- A2 / T2: hot pages ----------------------------------------------------

def page_window_counts(logs: DataFrame, size_ms: int = 20 * MINUTE_MS,
                       slide_ms: int = 5 * MINUTE_MS) -> DataFrame:
    """A2: GET hits per url per sliding window: url, window_end, count.

    In batch every row is on time, so the 1 s disorder bound and 1 min
    allowed lateness of the streaming job do not change the result.
    """
    g = get_requests(logs).select("url", "ts_ms")
    return sliding_counts(g, ["url"], "ts_ms", size_ms, slide_ms)


def hot_pages(logs: DataFrame, k: int = 3, size_ms: int = 20 * MINUTE_MS,
              slide_ms: int = 5 * MINUTE_MS) -> DataFrame:
    """Top ``k`` urls per window, one (final) count per url."""
    counts = page_window_counts(logs, size_ms, slide_ms)
    return top_k(counts, ["window_end"], [F.desc("count"), F.asc("url")], k) \
        .select("window_end", "rank", "url", "count")


def hot_pages_report(logs: DataFrame, k: int = 3) -> DataFrame:
    return _report(hot_pages(logs, k), "url", REPORT_PAGE_LABEL,
                   REPORT_PAGE_COUNT_LABEL, REPORT_PAGE_RULE_BOTTOM)


# ---- A3 / ST5: hourly page views -------------------------------------------

def pv_hourly(behaviors: DataFrame, size_ms: int = HOUR_MS) -> DataFrame:
    """A3: page views per tumbling hour: url ('pv'), window_end, count.

    A grouped count is already two-phase (partial count per task, then a
    sum per window), which is what the reference's random salting builds by
    hand.
    """
    pv = with_ms(page_views(behaviors))
    return (pv.groupBy(tumbling_end("ts_ms", size_ms).alias("window_end"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select(F.lit("pv").alias("url"), "window_end", "count"))


def salted_count(df: DataFrame, keys: list[str], buckets: int = 100,
                 salt_cols: list[str] | None = None, count_col: str = "count") -> DataFrame:
    """Two-phase count with an explicit salt (A3's hand-made form).

    Phase 1 counts per (keys, salt) so a hot key is spread over ``buckets``
    reducers; phase 2 sums the partial counts per key. The salt is a
    deterministic hash of ``salt_cols`` (all columns by default), so a
    retried task rebuilds the same buckets.
    """
    cols = salt_cols or df.columns
    salt = F.pmod(F.xxhash64(*cols), F.lit(buckets))
    part = df.groupBy(*keys, salt.alias("_salt")).agg(F.count(F.lit(1)).alias("_n"))
    return part.groupBy(*keys).agg(F.sum("_n").alias(count_col))


def pv_hourly_salted(behaviors: DataFrame, buckets: int = 100,
                     size_ms: int = HOUR_MS) -> DataFrame:
    """A3 + ST5 as written: salted partial counts, then a total per window."""
    pv = with_ms(page_views(behaviors)).withColumn(
        "window_end", tumbling_end("ts_ms", size_ms))
    c = salted_count(pv.select("window_end", "user_id", "item_id", "ts_sec", "seq"),
                     ["window_end"], buckets)
    return c.select(F.lit("pv").alias("url"), "window_end", "count")


# ---- A4 / A5: hourly unique visitors ----------------------------------------

def uv_hourly(behaviors: DataFrame, size_ms: int = HOUR_MS) -> DataFrame:
    """A4: distinct users per tumbling hour: url ('uv'), window_end, count.

    Planned as (window, user) dedup then a count per window -- two shuffled
    aggregates, no window funnelled through one task.
    """
    pv = with_ms(page_views_exact(behaviors))
    return (pv.groupBy(tumbling_end("ts_ms", size_ms).alias("window_end"))
            .agg(F.countDistinct("user_id").alias("count"))
            .select(F.lit("uv").alias("url"), "window_end", "count"))


def with_offset(df: DataFrame, mask: int = DEFAULT_MASK) -> DataFrame:
    """Add P7's bitmap ``offset`` of the user id."""
    return df.withColumn("offset", poly_hash(F.col("user_id").cast("string"), mask))


def uv_hourly_bitmap(behaviors: DataFrame, mask: int = DEFAULT_MASK,
                     size_ms: int = HOUR_MS) -> DataFrame:
    """A5: distinct bitmap offsets per hour (colliding users count once).

    The offset depends only on the user, so users are first deduplicated per
    hour (partial aggregation) and the hash -- a higher-order function,
    evaluated per row outside generated code -- runs once per (hour, user),
    not once per page view.
    """
    pv = with_ms(page_views_exact(behaviors))
    users = pv.select(tumbling_end("ts_ms", size_ms).alias("window_end"), "user_id").distinct()
    return (with_offset(users, mask).groupBy("window_end")
            .agg(F.countDistinct("offset").alias("count"))
            .select(F.lit("uv").alias("url"), "window_end", "count"))


def uv_hourly_approx(behaviors: DataFrame, rsd: float = 0.05,
                     size_ms: int = HOUR_MS) -> DataFrame:
    """A5, Spark-native: HyperLogLog++ sketch per hour (mergeable partials).

    Each map task ships one sketch per window; at ``rsd=0.05`` that is
    2^11 registers (~1.6 KB) instead of 2^14 at 0.01, which matters when
    windows x tasks is large. ``uv_hourly`` is the exact count."""
    pv = with_ms(page_views_exact(behaviors))
    return (pv.groupBy(tumbling_end("ts_ms", size_ms).alias("window_end"))
            .agg(F.approx_count_distinct("user_id", rsd).alias("count"))
            .select(F.lit("uv").alias("url"), "window_end", "count"))


def uv_running(behaviors: DataFrame, mask: int = DEFAULT_MASK,
               size_ms: int = HOUR_MS) -> DataFrame:
    """The per-row trigger's output -- one row each time a window's bitmap
    gains a bit: url ('uv'), window_end, count (running UV), user_id, ts_sec.

    The first row per (window, offset) in (ts_sec, seq) order is found with
    a min-aggregate (partial, skew-safe); the running number is then the
    exact rank of those first rows inside their window, computed per second
    so an hour with many users is not sorted in one task.
    """
    pv = with_ms(page_views_exact(behaviors)).withColumn(
        "window_end", tumbling_end("ts_ms", size_ms))
    # first row per (hour, user), then hash once per (hour, user), then the
    # first of those per (hour, offset): the same row, fewer hash calls
    # (ts_sec, seq) as one number, so both minima are hash aggregates
    wide = "decimal(38,0)"
    at = (F.col("ts_sec").cast(wide) * F.lit(SEQ_SPAN).cast("decimal(19,0)")
          + F.col("seq").cast(wide)).cast(wide)
    per_user = pv.groupBy("window_end", "user_id").agg(F.min(at).alias("_at"))
    firsts = (with_offset(per_user, mask).groupBy("window_end", "offset")
              .agg(F.min("_at").alias("_at"), F.min_by("user_id", "_at").alias("user_id")))
    span = F.lit(SEQ_SPAN).cast("decimal(19,0)")
    firsts = firsts.select("window_end", "user_id",
                           F.floor((F.col("_at") - F.pmod("_at", span)) / span).cast("long").alias("ts_sec"),
                           F.pmod("_at", span).cast("long").alias("seq"))
    ranked = rank_in_group(firsts, ["window_end"], "ts_sec", "seq", "count")
    return ranked.select(F.lit("uv").alias("url"), "window_end", "count",
                         "user_id", "ts_sec")


def user_offsets(behaviors: DataFrame, mask: int = DEFAULT_MASK) -> DataFrame:
    """P7 over the distinct users: user_id, offset."""
    return with_offset(behaviors.select("user_id").distinct(), mask)
