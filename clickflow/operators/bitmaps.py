"""Stored visitor bitmaps (A5): one bit per hashed user, merged by OR.

A row holds the bits of one (hour, bucket) as Spark's 4 KB bitmaps, 32,768
offsets each. Hours merge into days and days into all time without the page
views, and batches that arrive later merge in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.functions.hashing import DEFAULT_MASK
from clickflow.operators.behavior import HOUR_MS, page_views_exact, with_ms, with_offset
from clickflow.operators.windows import tumbling_end

DAY_MS = 86_400_000
BITMAPS = "window_end long, bucket long, bits binary"


def uv_bitmaps(behaviors: DataFrame, mask: int = DEFAULT_MASK, size_ms: int = HOUR_MS) -> DataFrame:
    """window_end, bucket, bits: the visitors of each hour. Users are
    deduplicated per hour first, so each is hashed once an hour."""
    pv = with_ms(page_views_exact(behaviors))
    users = pv.select(tumbling_end("ts_ms", size_ms).alias("window_end"), "user_id").distinct()
    o = with_offset(users, mask).select(
        "window_end", F.bitmap_bucket_number("offset").alias("bucket"),
        F.bitmap_bit_position("offset").alias("bit"))
    return o.groupBy("window_end", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """keys, bucket, bits: the OR of all rows of a key and bucket. Tasks merge
    their own rows before the shuffle."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_bits(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """keys, count: set bits of merged rows."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("count"))


def day_of(window_end: str = "window_end", size_ms: int = HOUR_MS):
    """Start (epoch ms) of the UTC day that a window lies in."""
    first = F.col(window_end) - size_ms
    return first - F.pmod(first, F.lit(DAY_MS))


def uv_rollup(bitmaps: DataFrame) -> DataFrame:
    """grain ('hour', 'day', 'all'), period (epoch ms of its start, 0 for
    'all'), count: visitors from stored hour bitmaps (of any number of rows per
    hour and bucket). Each grain merges the one below it."""
    hours = merge_bitmaps(bitmaps.withColumn("period", F.col("window_end") - HOUR_MS), ["period"])
    days = merge_bitmaps(hours.withColumn("period", F.col("period") - F.pmod("period", F.lit(DAY_MS))),
                         ["period"])
    every = merge_bitmaps(days.withColumn("period", F.lit(0).cast("long")), ["period"])
    parts = [count_bits(d, ["period"]).select(F.lit(g).alias("grain"), "period", "count")
             for g, d in (("hour", hours), ("day", days), ("all", every))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
