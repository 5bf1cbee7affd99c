"""App-log routing, raw archive, daily active users and dashboard queries
(F5, K5, ST1, P2-P4, A8-A12).

App logs arrive as JSON text ``value`` with an arrival sequence ``seq``
(topic offset / file line order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clickflow import schemas
from clickflow.functions.time import day_hour_minute, ms_utc_text
from clickflow.operators.windows import top_k
from clickflow.sources.scans import bad, decode_json, good

# Topic names of the router and dashboard labels.
START_TOPIC = "GMALL_START"
EVENT_TOPIC = "GMALL_EVENT"
DAU_METRIC_ID = "dau"
DAU_METRIC_NAME = "新增日活"
HISTOGRAM_SIZE = 24


def log_route(logs: DataFrame) -> DataFrame:
    """topic per log line: start logs (a non-null ``start``) vs events.
    Output: seq, topic, value (the line forwarded unchanged)."""
    topic = F.when(F.get_json_object("value", "$.start").isNotNull(),
                   F.lit(START_TOPIC)).otherwise(F.lit(EVENT_TOPIC))
    return logs.select("seq", topic.alias("topic"), "value")


def start_logs(logs: DataFrame) -> DataFrame:
    return log_route(logs).where(F.col("topic") == START_TOPIC).select("seq", "value")


def raw_log_archive(logs: DataFrame) -> DataFrame:
    """K5: every line verbatim with its event day ``dt`` (the archive's
    day partition): dt, value. Write with ``sinks.archive_logs``."""
    dt = ms_utc_text(F.get_json_object("value", "$.ts").cast("long"), "yyyy-MM-dd")
    return logs.select(dt.alias("dt"), "value")


def decode_app_logs(logs: DataFrame) -> DataFrame:
    """S7 for app logs, parsed once: seq, mid, uid, ar, ch, vc, ts (ms), dt and
    is_start (a non-null ``start``). Malformed lines are left out; see
    ``bad_app_logs``."""
    j = good(decode_json(logs, schemas.APP_LOG, keep=["seq"]))
    dt, _, _ = day_hour_minute(F.col("ts"))
    return j.select("seq", F.col("common.mid").alias("mid"),
                    F.col("common.uid").alias("uid"), F.col("common.ar").alias("ar"),
                    F.col("common.ch").alias("ch"), F.col("common.vc").alias("vc"),
                    "ts", dt.alias("dt"), F.col("start").isNotNull().alias("is_start"))


def bad_app_logs(logs: DataFrame) -> DataFrame:
    """App-log lines that are no JSON of the log's shape: seq, value."""
    return bad(decode_json(logs, schemas.APP_LOG, keep=["seq", "value"])).select("seq", "value")


def decoded_starts(logs: DataFrame) -> DataFrame:
    """The start logs of ``logs``, decoded."""
    return decode_app_logs(logs).where("is_start").drop("is_start")


def dau_first(logs: DataFrame) -> DataFrame:
    """ST1: the first start log of each device per UTC day, by (ts, seq).

    A min-aggregate over a struct led by the ordering keys: partial
    aggregation collapses a chatty device map-side, so no (day, device)
    group is ever gathered in one place. Output: dt, mid, uid, ar, ch, vc,
    ts, seq.
    """
    return _first_per_day(decoded_starts(logs))


def _first_per_day(d: DataFrame) -> DataFrame:
    first = d.groupBy("dt", "mid").agg(
        F.min(F.struct("ts", "seq", "uid", "ar", "ch", "vc")).alias("f"))
    return first.select("dt", "mid", "f.uid", "f.ar", "f.ch", "f.vc", "f.ts", "f.seq")


def dau_first_observed(logs: DataFrame) -> tuple[DataFrame, Observation, Observation]:
    """A12 as side metrics: ``dau_first`` plus two ``Observation``s holding
    the row counts before and after the dedup (``.get['rows']`` once an
    action has run). Collected with the job itself, no extra pass."""
    before, after = Observation("dedup_before"), Observation("dedup_after")
    d = decoded_starts(logs).observe(before, F.count(F.lit(1)).alias("rows"))
    out = _first_per_day(d).observe(after, F.count(F.lit(1)).alias("rows"))
    return out, before, after


def dau_docs(firsts: DataFrame) -> DataFrame:
    """The DAU document: id (dt_mid), mid, uid, ar, ch, vc, dt, hr,
    mi, ts. ``ar`` is the real area code (the reference copied mid into it)."""
    dt, hr, mi = day_hour_minute(F.col("ts"))
    return firsts.select(F.concat_ws("_", dt, F.col("mid")).alias("id"), "mid", "uid",
                         "ar", "ch", "vc", dt.alias("dt"), hr.alias("hr"),
                         mi.alias("mi"), "ts")


def dau_total(docs: DataFrame, dt: str | None = None) -> DataFrame:
    """A8 + A11: documents per day as dashboard rows: dt, id, name, value.
    With ``dt`` only that day's partition is read."""
    d = docs if dt is None else docs.where(F.col("dt") == dt)
    return d.groupBy("dt").agg(F.count(F.lit(1)).alias("value")).select(
        "dt", F.lit(DAU_METRIC_ID).alias("id"), F.lit(DAU_METRIC_NAME).alias("name"),
        "value")


def dau_by_minute_top24(docs: DataFrame, size: int = HISTOGRAM_SIZE) -> DataFrame:
    """A9 as written: a terms histogram on the minute field, the ``size``
    largest buckets per day (count desc, key asc): dt, mi, count, rank."""
    c = docs.groupBy("dt", "mi").agg(F.count(F.lit(1)).alias("count"))
    return top_k(c, ["dt"], [F.desc("count"), F.asc("mi")], size) \
        .select("dt", "mi", "count", "rank")


def dau_by_hour(docs: DataFrame) -> DataFrame:
    """A9 as intended: documents per (day, hour): dt, hr, count."""
    return docs.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("count"))


def dau_day_compare(docs: DataFrame) -> DataFrame:
    """A10: each day's hourly counts next to the previous day's:
    dt, day ('today' | 'yesterday'), hr, count.

    Every (dt, hr) count is emitted twice -- as 'today' for its own day and
    as 'yesterday' for the next calendar day (P10 fixed) -- so no join is
    needed and the documents are read once.
    """
    nxt = F.date_format(F.date_add(F.to_date("dt"), 1), "yyyy-MM-dd")
    both = F.array(F.struct(F.col("dt"), F.lit("today").alias("day")),
                   F.struct(nxt.alias("dt"), F.lit("yesterday").alias("day")))
    return (dau_by_hour(docs).select(F.explode(both).alias("d"), "hr", "count")
            .select("d.dt", "d.day", "hr", "count"))


def dedup_metrics(logs: DataFrame) -> DataFrame:
    """Start logs before and after the first-per-day dedup, per day:
    dt, rows_before, rows_after. Logs without a device count as one device,
    as in ``dau_first``."""
    d = decoded_starts(logs)
    # a struct is never NULL, so a NULL device is counted too
    return d.groupBy("dt").agg(F.count(F.lit(1)).alias("rows_before"),
                               F.countDistinct(F.struct("mid")).alias("rows_after"))



# ---- totals kept as deltas (A8-A10) ------------------------------------------

DELTAS = "dt string, hr string, delta long"


def hour_deltas(new_docs: DataFrame) -> DataFrame:
    """What a batch's new documents add to the totals: dt, hr, delta."""
    return new_docs.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("delta"))


def by_hour_from_deltas(deltas: DataFrame) -> DataFrame:
    """``dau_by_hour`` from stored deltas: dt, hr, count."""
    return deltas.groupBy("dt", "hr").agg(F.sum("delta").alias("count"))


def total_from_deltas(deltas: DataFrame) -> DataFrame:
    """``dau_total`` from stored deltas: dt, id, name, value."""
    return deltas.groupBy("dt").agg(F.sum("delta").alias("value")).select(
        "dt", F.lit(DAU_METRIC_ID).alias("id"), F.lit(DAU_METRIC_NAME).alias("name"), "value")
