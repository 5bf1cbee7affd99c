"""Marketing counts by channel and behaviour.

Input rows: user_id, behavior, channel, ts_ms, seq.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.operators.behavior import HOUR_MS
from clickflow.operators.windows import sliding_counts

SLIDE_MS = 5_000


def not_uninstall(events: DataFrame) -> DataFrame:
    """drop UNINSTALL; a NULL behaviour passes."""
    return events.where(~F.col("behavior").eqNullSafe(F.lit("UNINSTALL")))


def marketing_by_channel(events: DataFrame, size_ms: int = HOUR_MS,
                         slide_ms: int = SLIDE_MS) -> DataFrame:
    """Counts per (channel, behavior) per sliding window (1 h / 5 s):
    channel, behavior, window_end, count.

    Each row lies in 720 windows. Rows are counted per 5 s pane, and the
    window counts come from a running sum over pane deltas instead of a
    720-way fan-out (see ``sliding_counts_sweep``).
    """
    e = not_uninstall(events).select("channel", "behavior", "ts_ms")
    return sliding_counts(e, ["channel", "behavior"], "ts_ms", size_ms, slide_ms)
