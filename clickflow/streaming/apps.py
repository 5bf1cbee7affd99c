"""End-to-end streaming applications, built from the
operators, state and sinks of this package.

Each ``*_app`` starts its queries and returns them; every query checkpoints
under the shared folder, so a restarted app resumes where it stopped.
Sources are folders of files here (``open_stream(kind='files')``); on a
cluster with the Kafka connector pass a topic stream instead (the functions
taking a DataFrame do not care where it comes from).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickflow import schemas
from clickflow.operators import cdc, dau, orders
from clickflow.operators.windows import rank_in_group
from clickflow.session import sub_dir
from clickflow.sinks import (docs_store, ranked_batches, read_user_state, touched_buckets, update_user_state,
                             upsert_docs, write_batch)
from clickflow.sinks.store import Store
from clickflow.sinks.writers import BATCH, STATE_BUCKETS
from clickflow.sources import scans
from clickflow.streaming import jobs, keyed
from clickflow.streaming.run import DEFAULT_INTERVAL, start

ORDER_TOPIC = "ODS_ORDER_INFO"


def dau_app(logs: DataFrame, docs_path: str, archive_path: str | None = None,
            trigger: str = DEFAULT_INTERVAL, name: str = "dau",
            delay: str = jobs.DEVICE_DELAY, totals_path: str | None = None) -> list[StreamingQuery]:
    """E3 (and E2): app logs (``seq``, ``value``) -> first start log per
    (day, device) -> DAU documents upserted into a ``dt``-partitioned store
    (``dau.dau_total`` / ``dau_by_hour`` query it). With ``totals_path`` each
    batch also adds what its new documents change in the hourly totals, which
    ``dau.by_hour_from_deltas`` / ``total_from_deltas`` over ``totals_store``
    sum up. With ``archive_path`` every raw line is also archived by day (K5)."""
    spark = logs.sparkSession
    firsts = jobs.dau_first_stream(logs, delay)

    def write_docs(batch: DataFrame, batch_id: int) -> None:
        docs = dau.dau_docs(batch)
        upsert_docs(docs, docs_path, batch_id)
        if totals_path:
            add_totals(spark, docs_path, docs.schema, totals_path, batch_id)

    qs = [start(firsts, name, sink="foreach_batch", foreach_batch=write_docs, trigger=trigger,
                checkpoint=sub_dir(spark, "streams", name))]
    if archive_path:
        qs.append(start(dau.raw_log_archive(logs), f"{name}_archive", sink="text",
                        path=archive_path, partition_by=["dt"], trigger=trigger,
                        checkpoint=sub_dir(spark, "streams", f"{name}_archive")))
    return qs


def totals_store(spark: SparkSession, path: str) -> Store:
    """The hourly deltas, in folders per day."""
    return Store(spark, path, dau.DELTAS, "dt")


def add_totals(spark: SparkSession, docs_path: str, schema, totals_path: str, batch_id: int) -> None:
    """Store the deltas of the documents that a batch added. They are counted
    from the batch's own stored rows, so a replay gives the same ones."""
    new = docs_store(spark, docs_path, schema).read(before=batch_id + 1).where(F.col(BATCH) == batch_id)
    totals_store(spark, totals_path).append(dau.hour_deltas(new), batch_id)


def cdc_app(envelopes: DataFrame, topics_path: str, form: str = "object",
            trigger: str = DEFAULT_INTERVAL, name: str = "cdc") -> StreamingQuery:
    """E4, first hop: split CDC envelopes (``form`` 'array' or 'object') into
    per-table topics (one folder per ``ODS_<TABLE>``)."""
    split = cdc.cdc_split_array if form == "array" else cdc.cdc_split_object
    return start(split(envelopes), name, sink="text", path=topics_path,
                 partition_by=["topic"], trigger=trigger,
                 checkpoint=sub_dir(envelopes.sparkSession, "streams", name))


def order_app(order_values: DataFrame, state_path: str, provinces: DataFrame,
              users: DataFrame, out_path: str, trigger: str = DEFAULT_INTERVAL,
              name: str = "orders", buckets: int = STATE_BUCKETS,
              bad_path: str | None = None) -> StreamingQuery:
    """E4, second hop: order JSON -> typed order (S8) with create date/hour
    (P8), first-order flag (J1), province and user dimensions (J3, J4); then
    the batch's buyers are consumed (J5).

    A user's first order is the earliest of the first batch that has one,
    unless the state from before says consumed. The state a batch sees is
    what earlier batches stored, in the buckets of its users, so a batch that
    runs again flags its orders the same. Malformed records go to
    ``bad_path`` if given."""
    spark = order_values.sparkSession
    decoded = scans.decode_orders(order_values, keep=["value"])

    def write(batch: DataFrame, batch_id: int) -> None:
        # two writes from one micro-batch: keep it while both run (a lost
        # block is recomputed from the batch's fixed source offsets)
        batch.persist()
        try:
            if bad_path:
                write_batch(scans.bad(batch).select("value"), bad_path, batch_id)
            good = orders.order_time_parts(scans.good(batch).drop("value"))
            state = read_user_state(spark, state_path, batch_id, touched_buckets(good, buckets))
            enriched = orders.order_with_user(orders.order_with_province(
                orders.order_first_flag(good, state, within_batch=True), provinces), users)
            write_batch(enriched, out_path, batch_id)
            update_user_state(good, state_path, batch_id, buckets)
        finally:
            batch.unpersist()

    return start(decoded, name, sink="foreach_batch", foreach_batch=write, trigger=trigger,
                 checkpoint=sub_dir(spark, "streams", name))


def order_state_app(order_values: DataFrame, provinces: DataFrame, users: DataFrame,
                    out_path: str, user_state: DataFrame | None = None,
                    trigger: str = DEFAULT_INTERVAL, name: str = "orders",
                    bad_path: str | None = None) -> list[StreamingQuery]:
    """``order_app`` with the users' consumed flags in keyed state (J5), seeded
    from ``user_state`` when the query first starts: a batch reads its own
    orders and the dimensions and nothing that earlier batches wrote. The
    enriched orders go to a file sink, which takes each batch once. Malformed
    records go to ``bad_path`` by a query of their own."""
    spark = order_values.sparkSession
    good = orders.order_time_parts(scans.good(scans.decode_orders(order_values)))
    flagged = keyed.first_order_stream(good, user_state)
    enriched = orders.order_with_user(orders.order_with_province(flagged, provinces), users)
    qs = [start(enriched, name, path=out_path, trigger=trigger,
                checkpoint=sub_dir(spark, "streams", name))]
    if bad_path:
        bad = scans.bad(scans.decode_orders(order_values, keep=["value"])).select("value")
        qs.append(start(bad, f"{name}_bad", sink="text", path=bad_path, trigger=trigger,
                        checkpoint=sub_dir(spark, "streams", f"{name}_bad")))
    return qs


def order_values_from_topics(spark, topics_path: str) -> DataFrame:
    """The ``ODS_ORDER_INFO`` folder written by ``cdc_app`` as a stream."""
    return spark.readStream.schema("value string").text(f"{topics_path}/topic={ORDER_TOPIC}")


def hot_items_app(behaviors: DataFrame, out_path: str, k: int = 5,
                  trigger: str = DEFAULT_INTERVAL, name: str = "hot_items",
                  delay: str = "0 seconds") -> StreamingQuery:
    """Behaviour rows (up to ``delay`` out of order) -> page views per item
    per 1 h / 5 min window -> top ``k`` per window, one ranked folder per
    micro-batch. ``jobs.hot_items_stream`` is the same as one plan."""
    counts = jobs.item_window_counts_stream(behaviors, delay=delay)
    writer = ranked_batches(out_path, ["window_end"], [F.desc("count"), F.asc("item_id")], k,
                            ["window_end", "rank", "item_id", "count"])
    return start(counts, name, sink="foreach_batch", foreach_batch=writer, trigger=trigger,
                 checkpoint=sub_dir(behaviors.sparkSession, "streams", name))


def ad_app(clicks: DataFrame, out_dir: str, cap: int = 100,
           trigger: str = DEFAULT_INTERVAL, name: str = "ads",
           delay: str = jobs.DAY_DELAY) -> StreamingQuery:
    """Ad clicks: one query keeps the per-(user, ad, day) cap's state and
    writes both outputs of it, the passed clicks (``passed``) and the cap's
    warnings (``warnings``), so they always agree. ``ad_province_app`` counts
    the passed clicks."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()   # two outputs of one batch: the state runs once
        try:
            passed, warns = jobs.split_ad_outcomes(batch)
            write_batch(passed, f"{out_dir}/passed", batch_id)
            write_batch(warns, f"{out_dir}/warnings", batch_id)
        finally:
            batch.unpersist()

    return start(jobs.ad_click_outcomes_stream(clicks, cap, delay), name, sink="foreach_batch",
                 foreach_batch=write, trigger=trigger,
                 checkpoint=sub_dir(clicks.sparkSession, "streams", name))


def ad_province_app(spark: SparkSession, out_dir: str, trigger: str = DEFAULT_INTERVAL,
                    name: str = "ads_province", delay: str = jobs.DAY_DELAY) -> StreamingQuery:
    """Province counts over 1 h / 5 min windows of ``ad_app``'s passed clicks."""
    passed = (spark.readStream.schema(schemas.AD_CLICK).parquet(f"{out_dir}/passed")
              .select(*[f.name for f in schemas.AD_CLICK]))
    return start(jobs.ad_clicks_by_province_stream(passed, delay=delay), name, sink="parquet",
                 path=f"{out_dir}/by_province", trigger=trigger,
                 checkpoint=sub_dir(spark, "streams", name))


def route_late_app(flagged: DataFrame, out_path: str, trigger: str = DEFAULT_INTERVAL,
                   name: str = "late") -> StreamingQuery:
    """Rows of ``keyed.with_late_flag`` in one file sink, split by ``late``:
    the folder ``late=true`` parks the late rows, ``on_time_rows`` streams the
    others."""
    return start(flagged, name, path=out_path, partition_by=["late"], trigger=trigger,
                 checkpoint=sub_dir(flagged.sparkSession, "streams", name))


def on_time_rows(spark: SparkSession, routed_path: str, schema) -> DataFrame:
    """The on-time rows of ``route_late_app`` as a stream. It takes whole
    batches of the router (no limit of files per trigger), so a query with the
    router's ``delay`` never is ahead of the watermark they were compared with
    and drops none of them."""
    return (spark.readStream.schema(_routed(schema)).parquet(routed_path)
            .where("not late").drop("late"))


def parked_rows(spark: SparkSession, routed_path: str, schema) -> DataFrame:
    """The late rows that ``route_late_app`` has parked, with ``watermark_ms``,
    the watermark that had passed them; only their folder is read."""
    return spark.read.schema(_routed(schema)).parquet(routed_path).where("late").drop("late")


def _routed(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField("watermark_ms", T.LongType()),
                         T.StructField("late", T.BooleanType())])


def uv_running_app(behaviors: DataFrame, out_path: str, mask: int = jobs.DEFAULT_MASK,
                   delay: str = "0 seconds", trigger: str = DEFAULT_INTERVAL,
                   name: str = "uv_running") -> StreamingQuery:
    """The running UV per hour, exact for rows up to ``delay`` out of order.

    A batch of ``uv_final_firsts_stream`` holds whole seconds, later ones than
    all batches before. Its rows are counted per (hour, second), a running sum
    over the seconds and what earlier batches counted of the hour give each
    second's offset, and rows are numbered only inside their second, so an
    hour's visitors are spread over its seconds."""
    spark = behaviors.sparkSession
    totals = Store(spark, f"{out_path}/totals", "window_end long, n long")
    ranks = Store(spark, f"{out_path}/ranks", UV_RANKS)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            before = totals.read(before=batch_id).groupBy("window_end").agg(F.sum("n").alias("before"))
            ranked = rank_in_group(batch, ["window_end"], "ts_sec", "seq", "count")
            ranks.append(ranked.join(before, "window_end", "left").select(
                F.lit("uv").alias("url"), "window_end",
                (F.col("count") + F.coalesce("before", F.lit(0))).alias("count"), "user_id", "ts_sec"),
                batch_id)
            totals.append(batch.groupBy("window_end").agg(F.count(F.lit(1)).alias("n")), batch_id)
        finally:
            batch.unpersist()

    return start(jobs.uv_final_firsts_stream(behaviors, mask, delay), name, sink="foreach_batch",
                 foreach_batch=write, trigger=trigger, checkpoint=sub_dir(spark, "streams", name))


UV_RANKS = "url string, window_end long, count long, user_id long, ts_sec long"


def read_uv_running(spark: SparkSession, out_path: str) -> DataFrame:
    """The rows that ``uv_running_app`` wrote."""
    return Store(spark, f"{out_path}/ranks", UV_RANKS).read().drop(BATCH)
