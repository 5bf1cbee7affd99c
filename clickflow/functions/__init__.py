"""Column-level helpers: time, hashing, text."""

from clickflow.functions.hashing import DEFAULT_MASK, poly_hash
from clickflow.functions.text import has_token, highlight, token_hits, tokens
from clickflow.functions.time import (
    day_hour_minute, epoch_day, event_time, event_time_ms, java_timestamp_text,
    ms_utc_text, ntz_epoch_seconds, previous_day_key, utc_text, utc_wall,
)

__all__ = [
    "DEFAULT_MASK", "poly_hash", "has_token", "highlight", "token_hits",
    "tokens", "day_hour_minute", "epoch_day", "event_time", "event_time_ms",
    "java_timestamp_text", "ms_utc_text", "ntz_epoch_seconds",
    "previous_day_key", "utc_text", "utc_wall",
]
