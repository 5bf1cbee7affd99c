"""Time helpers.

Event time travels as epoch numbers (``ts_sec`` seconds or ``ts_ms``
milliseconds) so window arithmetic is plain integer math and never depends
on the session time zone. Text renderings are always UTC wall-clock.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz_epoch_seconds(col: str | Column) -> Column:
    """Whole epoch seconds (floored) of a TIMESTAMP_NTZ value read as UTC."""
    name = col if isinstance(col, str) else None
    if name is None:
        raise TypeError("pass the column name")
    return F.expr(f"timestampdiff(SECOND, {EPOCH_NTZ}, `{name}`)")


def event_time(sec: str | Column) -> Column:
    """Epoch seconds -> TIMESTAMP instant (for watermarks / streams)."""
    return F.timestamp_seconds(_c(sec))


def event_time_ms(ms: str | Column) -> Column:
    """Epoch milliseconds -> TIMESTAMP instant."""
    return F.timestamp_millis(_c(ms))


def utc_wall(ts: str | Column) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ holding its UTC wall clock.

    Formatting the result is independent of ``spark.sql.session.timeZone``.
    """
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"),
                              _c(ts).cast("timestamp_ntz"))


def utc_text(ts: str | Column, pattern: str) -> Column:
    return F.date_format(utc_wall(ts), pattern)


def ms_utc_text(ms: str | Column, pattern: str) -> Column:
    return utc_text(F.timestamp_millis(_c(ms)), pattern)


def java_timestamp_text(ms: str | Column) -> Column:
    """Epoch ms rendered like ``java.sql.Timestamp.toString`` for whole seconds
    (``yyyy-MM-dd HH:mm:ss.0``), in UTC: the window-end text of P6/P9."""
    return F.concat(ms_utc_text(ms, "yyyy-MM-dd HH:mm:ss"), F.lit(".0"))


def day_hour_minute(ms: str | Column) -> tuple[Column, Column, Column]:
    """Epoch ms -> (dt 'yyyy-MM-dd', hr 'HH', mi 'mm') in UTC."""
    wall = utc_wall(F.timestamp_millis(_c(ms)))
    return (F.date_format(wall, "yyyy-MM-dd"), F.date_format(wall, "HH"),
            F.date_format(wall, "mm"))


def epoch_day(sec: str | Column) -> Column:
    """UTC day number of epoch seconds (the click-cap reset key)."""
    return F.floor(_c(sec) / F.lit(86400)).cast("long")


def previous_day_key(day_key: str | Column) -> Column:
    """P10, fixed: 'yyyyMMdd' -> the calendar day before, same format
    (the integer-minus-one form breaks on the first of a month)."""
    return F.date_format(F.date_sub(F.to_date(_c(day_key), "yyyyMMdd"), 1),
                         "yyyyMMdd")
