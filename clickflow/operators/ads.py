"""Ad-click analytics: click cap (ST2), cap warnings (ST3), clicks by
province over sliding windows (A6).

Input rows: user_id, ad_id, province, city, ts_sec, seq (arrival order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.functions.time import epoch_day
from clickflow.operators.behavior import HOUR_MS, MINUTE_MS
from clickflow.operators.windows import first_in_group, rank_in_group, sliding_counts

DEFAULT_CAP = 100

# The warning text is "click over" + cap + "次".
WARNING_PREFIX = "click over"
WARNING_SUFFIX = "次"

CLICK_COLUMNS = ["user_id", "ad_id", "province", "city", "ts_sec", "seq"]


def warning_text(cap: int) -> str:
    return f"{WARNING_PREFIX}{cap}{WARNING_SUFFIX}"


def _cap_groups(reset: str | None) -> list[str]:
    return ["user_id", "ad_id"] + (["_day"] if reset == "day" else [])


def _with_day(clicks: DataFrame, reset: str | None) -> DataFrame:
    c = clicks.select(*CLICK_COLUMNS)
    if reset not in ("day", None):
        raise ValueError("reset must be 'day' or None")
    return c.withColumn("_day", epoch_day("ts_sec")) if reset == "day" else c


def ranked_clicks(clicks: DataFrame, reset: str | None = "day",
                  materialize: bool = False) -> DataFrame:
    """Every click with its 1-based position among the clicks of the same
    (user, ad[, UTC day]) in (ts_sec, seq) order: column ``click_no``.

    ``reset='day'`` restarts the count at each UTC midnight of event time
    (the reference's timer aimed at midnight but mixed clocks);
    ``reset=None`` never restarts. ``materialize`` checkpoints the clicks
    before ranking (see ``rank_in_group``).
    """
    c = _with_day(clicks, reset)
    return rank_in_group(c, _cap_groups(reset), "ts_sec", "seq", "click_no", materialize).drop("_day")


def first_clicks(clicks: DataFrame, n: int, reset: str | None = "day") -> DataFrame:
    """The first ``n`` clicks of each group with ``click_no``; the rest is
    dropped before the shuffle."""
    c = _with_day(clicks, reset)
    return first_in_group(c, _cap_groups(reset), ["ts_sec", "seq"], n, "click_no").drop("_day")


def ad_click_cap(clicks: DataFrame, cap: int = DEFAULT_CAP,
                 reset: str | None = "day") -> DataFrame:
    """ST2: the clicks that pass -- the first ``cap`` of each group."""
    return first_clicks(clicks, cap, reset).select(*CLICK_COLUMNS)


def ad_click_warnings(clicks: DataFrame, cap: int = DEFAULT_CAP,
                      reset: str | None = "day") -> DataFrame:
    """ST3: one warning per capped group, at its first dropped click:
    user_id, ad_id, warning, ts_sec."""
    return (first_clicks(clicks, cap + 1, reset).where(F.col("click_no") == cap + 1)
            .select("user_id", "ad_id", F.lit(warning_text(cap)).alias("warning"),
                    "ts_sec"))


def ad_click_outcomes(clicks: DataFrame, cap: int = DEFAULT_CAP,
                      reset: str | None = "day", materialize: bool = False) -> DataFrame:
    """Both outputs in one pass: every click tagged ``pass``, ``warn`` (the
    first dropped one) or ``drop``; split with a filter."""
    r = ranked_clicks(clicks, reset, materialize)
    n = F.col("click_no")
    tag = (F.when(n <= cap, F.lit("pass")).when(n == cap + 1, F.lit("warn"))
           .otherwise(F.lit("drop")))
    return r.withColumn("outcome", tag)


def ad_clicks_by_province(passed: DataFrame, size_ms: int = HOUR_MS,
                          slide_ms: int = 5 * MINUTE_MS) -> DataFrame:
    """Passed clicks per province per sliding window:
    province, window_end, count."""
    p = passed.select("province", (F.col("ts_sec") * 1000).alias("ts_ms"))
    return sliding_counts(p, ["province"], "ts_ms", size_ms, slide_ms)
