"""Streaming forms equal the batch forms on an in-order replay.

Inputs are replayed as ordered files (one per micro-batch) followed by one
far-future sentinel row, which moves the watermark past every real window
so append-mode results are complete; the sentinel's own window never closes.
"""

import collections
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from clickflow.operators import ads, behavior as bh, dau, marketing
from clickflow.plans.tables import Tables
from clickflow.sinks import ranked_batches, upsert_docs
from clickflow.sources import adapt, scans
from clickflow.streaming import jobs
from clickflow.streaming.run import drain, late_rows, start
from clickflow.streaming.sources import open_stream
from replay import write_replay
from conftest import SF_SMALL, rows


def plan(df):
    """The analysed plan: a streaming frame has no optimized one outside a query."""
    return df._jdf.queryExecution().analyzed().toString()


SENTINEL_SEC = 4_102_444_800  # 2100-01-01
SENTINEL_SEQ = 10 ** 12
N_FILES = 4


def _csv_lines(df):
    return df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns]).alias("value"),
                     "seq")


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF_SMALL)


@pytest.fixture(scope="module")
def behavior_dir(spark, tables, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("behaviors"))
    write_replay(_csv_lines(tables.behaviors()), d, "seq", N_FILES)
    spark.createDataFrame([(f"0,0,0,pv,{SENTINEL_SEC},{SENTINEL_SEQ}",)], "value string") \
        .coalesce(1).write.mode("append").text(d)
    return d


def _behavior_stream(spark, d, max_files=1):
    return scans.good(scans.parse_behavior_lines(
        open_stream(spark, path=d, fmt="text", max_files_per_trigger=max_files)))


def _run(df, name, scratch, mode="append"):
    drain(start(df, name, sink="memory", mode=mode, trigger="availableNow",
                checkpoint=os.path.join(scratch, name)))
    return df.sparkSession.table(name)


def test_item_counts_and_hot_items(spark, tables, behavior_dir, scratch):
    s = jobs.item_window_counts_stream(_behavior_stream(spark, behavior_dir))
    got = _run(s, "s_item_counts", scratch)
    assert rows(got) == rows(bh.item_window_counts(tables.behaviors()))
    out = os.path.join(scratch, "hot")
    writer = ranked_batches(out, ["window_end"], [F.desc("count"), F.asc("item_id")], 5,
                            ["window_end", "rank", "item_id", "count"])
    s2 = jobs.item_window_counts_stream(_behavior_stream(spark, behavior_dir))
    drain(start(s2, "s_hot", sink="foreach_batch", foreach_batch=writer, trigger="availableNow",
                checkpoint=os.path.join(scratch, "ck_hot")))
    hot = spark.read.parquet(out).drop("batch_id")
    assert rows(hot) == rows(bh.hot_items(tables.behaviors()))


@pytest.mark.parametrize("fn,batch", [
    (jobs.pv_hourly_stream, bh.pv_hourly),
    (jobs.pv_hourly_salted_stream, bh.pv_hourly),
    (jobs.uv_hourly_stream, bh.uv_hourly),
    (lambda b: jobs.uv_hourly_bitmap_stream(b, 63), lambda b: bh.uv_hourly_bitmap(b, 63)),
    (jobs.uv_hourly_approx_stream, bh.uv_hourly_approx),
])
def test_hourly_pv_uv(spark, tables, behavior_dir, scratch, fn, batch):
    got = _run(fn(_behavior_stream(spark, behavior_dir)), f"s_hourly_{abs(hash(fn))}", scratch)
    assert rows(got) == rows(batch(tables.behaviors()))


def test_uv_running_two_stage(spark, tables, behavior_dir, scratch):
    firsts = os.path.join(scratch, "firsts")
    s1 = jobs.uv_first_offsets_stream(_behavior_stream(spark, behavior_dir), 63)
    assert "Python" not in plan(s1)
    drain(start(s1, "s_uv1", sink="parquet", path=firsts, trigger="availableNow",
                checkpoint=os.path.join(scratch, "ck_uv1")))
    s2 = jobs.uv_running_stream(spark.readStream.schema(spark.read.parquet(firsts).schema)
                                .parquet(firsts))
    got = _run(s2, "s_uv2", scratch).where(F.col("ts_sec") < SENTINEL_SEC)
    # any row of the batch may be the one that sets the bit, so users and
    # seconds may differ from the batch form; windows and numbers may not
    key = ["window_end", "count"]
    assert rows(got, key) == rows(bh.uv_running(tables.behaviors(), 63), key)


def test_hot_pages_update_mode_keeps_last(spark, tables, scratch):
    d = os.path.join(scratch, "logs")
    lines = adapt.access_log_lines(tables.raw("events"), keep=("event_id",))
    write_replay(lines.withColumnRenamed("event_id", "seq"), d, "seq", 1)
    s = scans.good(scans.parse_access_log_lines(open_stream(spark, path=d, fmt="text")))
    got = _run(jobs.page_window_counts_stream(s), "s_pages", scratch, mode="update")
    last = got.groupBy("url", "window_end").agg(F.max("count").alias("count"))
    # update mode emits open windows too, so every (url, window) must be there
    assert rows(last) == rows(bh.page_window_counts(tables.access_logs()))


def test_ad_click_cap_and_province(spark, tables, scratch):
    d = os.path.join(scratch, "clicks")
    write_replay(_csv_lines(tables.ad_clicks()), d, "seq", N_FILES)
    spark.createDataFrame([(f"0,0,ZZ,ZZ,{SENTINEL_SEC},{SENTINEL_SEQ}",)], "value string") \
        .coalesce(1).write.mode("append").text(d)
    clicks = scans.good(scans.parse_ad_click_lines(
        open_stream(spark, path=d, fmt="text", max_files_per_trigger=1)))
    passed_dir, warn_dir = os.path.join(scratch, "passed"), os.path.join(scratch, "warns")

    def write(batch, batch_id):
        p, w = jobs.split_ad_outcomes(batch)
        p.write.mode("overwrite").parquet(f"{passed_dir}/batch_id={batch_id}")
        w.write.mode("overwrite").parquet(f"{warn_dir}/batch_id={batch_id}")

    drain(start(jobs.ad_click_outcomes_stream(clicks, cap=2), "s_cap", sink="foreach_batch",
                foreach_batch=write, trigger="availableNow",
                checkpoint=os.path.join(scratch, "ck_cap")))
    real = F.col("ts_sec") < SENTINEL_SEC
    passed = spark.read.parquet(passed_dir).drop("batch_id")
    assert rows(passed.where(real)) == rows(ads.ad_click_cap(tables.ad_clicks(), 2))
    warns = spark.read.parquet(warn_dir).drop("batch_id")
    assert rows(warns) == rows(ads.ad_click_warnings(tables.ad_clicks(), 2))
    ps = spark.readStream.schema(passed.schema).parquet(passed_dir).drop("batch_id")
    got = _run(jobs.ad_clicks_by_province_stream(ps), "s_prov", scratch)
    assert rows(got) == rows(E.queries()["ad_clicks_by_province"](spark, SF_SMALL))


def test_marketing_panes_stream(spark, tables, scratch):
    d = os.path.join(scratch, "mkt")
    m = tables.marketing()
    write_replay(m, d, "seq", 2, fmt="parquet")
    spark.createDataFrame([(0, "CLICK", "wechat", SENTINEL_SEC * 1000, SENTINEL_SEQ)], m.schema) \
        .write.mode("append").parquet(d)
    s = open_stream(spark, path=d, fmt="parquet", schema=m.schema, max_files_per_trigger=1)
    got = _run(jobs.marketing_by_channel_stream(s), "s_mkt", scratch)
    assert rows(got) == rows(marketing.marketing_by_channel(m))


def test_dau_first_stream_and_doc_upsert(spark, tables, scratch):
    d = os.path.join(scratch, "applogs")
    logs = tables.app_logs()
    write_replay(logs, d, "seq", N_FILES, fmt="parquet")
    sentinel = ('{"common":{"mid":"zz","uid":"0","ar":"0","ch":"x","vc":"v0"},'
                '"start":{},"ts":%d}' % (SENTINEL_SEC * 1000))
    spark.createDataFrame([(SENTINEL_SEQ, sentinel)], logs.schema).write.mode("append").parquet(d)
    s = open_stream(spark, path=d, fmt="parquet", schema=logs.schema, max_files_per_trigger=1)
    got = _run(jobs.dau_first_stream(s), "s_dau", scratch).where("mid <> 'zz'")
    assert "Python" not in plan(jobs.dau_first_stream(s))
    want = dau.dau_first(logs)
    assert rows(got, ["dt", "mid"]) == rows(want, ["dt", "mid"])
    starts = dau.decoded_starts(logs).select(*got.columns)
    assert got.join(starts, got.columns, "left_anti").count() == 0
    # K3: a document store; replaying a batch, or its keys later, changes nothing
    out = os.path.join(scratch, "docs")
    docs = dau.dau_docs(want)
    first, later = docs.where("hr < '12'"), docs
    upsert_docs(first, out, 0)
    for batch_id in (1, 1, 2):
        upsert_docs(later, out, batch_id)
    upsert_docs(first, out, 0)
    stored = spark.read.schema(docs.schema).parquet(out).select(*docs.columns)
    assert rows(stored) == rows(docs)


def test_restart_resumes_from_checkpoint(spark, tables, scratch):
    d = os.path.join(scratch, "restart")
    lines = _csv_lines(tables.behaviors())
    bounds = lines.agg(F.min("seq"), F.max("seq")).first()
    mid = (bounds[0] + bounds[1]) // 2
    write_replay(lines.where(F.col("seq") <= mid), d, "seq", 2)
    ck, out = os.path.join(scratch, "ck_restart"), os.path.join(scratch, "out_restart")

    def run_once():
        s = jobs.pv_hourly_stream(_behavior_stream(spark, d))
        drain(start(s, "s_restart", sink="parquet", path=out, trigger="availableNow",
                    checkpoint=ck))

    run_once()
    first = spark.read.parquet(out).count()
    write_replay(lines.where(F.col("seq") > mid), d, "seq", 2)
    spark.createDataFrame([(f"0,0,0,pv,{SENTINEL_SEC},{SENTINEL_SEQ}",)], "value string") \
        .coalesce(1).write.mode("append").text(d)
    run_once()
    got = spark.read.parquet(out)
    assert 0 < first < got.count()
    assert rows(got) == rows(bh.pv_hourly(tables.behaviors()))


def test_stateless_jobs_run_on_streams(spark, tables, scratch):
    d = os.path.join(scratch, "cdc")
    env = tables.cdc_array().withColumn("seq", F.monotonically_increasing_id())
    write_replay(env, d, "seq", 2, fmt="parquet")
    from clickflow.operators import cdc
    s = open_stream(spark, path=d, fmt="parquet", schema=env.schema)
    got = _run(cdc.cdc_split_array(s), "s_cdc", scratch)
    assert rows(got) == rows(cdc.cdc_split_array(tables.cdc_array()))


def test_order_first_flag_stream_static_join(spark, tables, scratch):
    from clickflow.operators import orders as od
    d = os.path.join(scratch, "orders")
    oj = tables.order_json().withColumnRenamed("id", "seq")
    write_replay(oj, d, "seq", 2, fmt="parquet")
    s = open_stream(spark, path=d, fmt="parquet", schema=oj.schema)
    flags = od.order_first_flag(scans.good(scans.decode_orders(s)), tables.user_state())
    got = _run(flags.select("id", "user_id", "if_first_order"), "s_flags", scratch)
    want = E.queries()["order_first_flag"](spark, SF_SMALL)
    assert rows(got) == rows(want)


def test_topic_and_archive_sinks(spark, tables, scratch):
    from clickflow.sinks import archive_logs, write_topic
    logs = tables.app_logs()
    routed = dau.log_route(logs)
    topics = os.path.join(scratch, "topics")
    write_topic(routed, path=topics)
    back = spark.read.text(topics)
    assert back.count() == logs.count()
    assert {r.topic for r in back.select("topic").distinct().collect()} == \
        {dau.START_TOPIC, dau.EVENT_TOPIC}
    arch = os.path.join(scratch, "archive")
    archive_logs(dau.raw_log_archive(logs), arch)
    stored = spark.read.text(arch)
    assert rows(stored.select("value")) == rows(logs.select("value"))


def test_dedup_observed_metrics(spark, tables):
    out, before, after = dau.dau_first_observed(tables.app_logs())
    n = out.count()
    assert after.get["rows"] == n
    want = E.queries()["dedup_metrics"](spark, SF_SMALL).agg(
        F.sum("rows_before").alias("b"), F.sum("rows_after").alias("a")).first()
    assert before.get["rows"] == want.b and n == want.a


def test_hot_pages_disorder_within_delay(spark, tables, scratch):
    """Rows arrive out of order by up to 30 s, inside the 61 s delay: the last
    update per (url, window) equals the batch count."""
    keyed = adapt.access_log_lines(tables.raw("events"), keep=("event_id", "ts_sec"))
    # reverse the order inside every 30 s bucket
    order = F.floor(F.col("ts_sec") / 30) * 10 ** 7 + (10 ** 7 - 1 - F.col("event_id"))
    d = os.path.join(scratch, "disorder")
    write_replay(keyed.select("value", order.alias("seq")), d, "seq", N_FILES)
    spark.createDataFrame([(f"1.1.1.1 0 - 01/01/2100:00:00:00 +0000 GET /sentinel",)],
                          "value string").coalesce(1).write.mode("append").text(d)
    s = scans.good(scans.parse_access_log_lines(
        open_stream(spark, path=d, fmt="text", max_files_per_trigger=1)))
    got = _run(jobs.page_window_counts_stream(s), "s_disorder", scratch, mode="update")
    last = (got.where("url <> '/sentinel'").groupBy("url", "window_end")
            .agg(F.max("count").alias("count")))
    assert rows(last) == rows(bh.page_window_counts(tables.access_logs()))
    # T2 with re-fires: latest counts per window, re-ranked as windows change
    from clickflow.sinks import latest_ranks, rerank_windows
    counts, ranks = os.path.join(scratch, "pg_counts"), os.path.join(scratch, "pg_ranks")
    s2 = scans.good(scans.parse_access_log_lines(
        open_stream(spark, path=d, fmt="text", max_files_per_trigger=1)))
    drain(start(jobs.page_window_counts_stream(s2), "s_rerank", sink="foreach_batch",
                mode="update", trigger="availableNow",
                foreach_batch=rerank_windows(counts, ranks, "url", 3),
                checkpoint=os.path.join(scratch, "ck_rerank")))
    want = bh.hot_pages(tables.access_logs())
    got_ranks = latest_ranks(spark, ranks, want.schema).where("url <> '/sentinel'")
    assert rows(got_ranks.select(*want.columns)) == rows(want)


def test_user_state_update_stream(spark, tables, scratch):
    from clickflow.sinks import init_user_state, read_user_state, update_user_state
    d = os.path.join(scratch, "orders_state")
    oj = tables.order_json().withColumnRenamed("id", "seq")
    write_replay(oj, d, "seq", 3, fmt="parquet")
    state = os.path.join(scratch, "state")
    # start from the existing state, as the service would
    init_user_state(tables.user_state(), state)
    s = scans.decode_orders(open_stream(spark, path=d, fmt="parquet", schema=oj.schema,
                                        max_files_per_trigger=1))
    drain(start(s, "s_state", sink="foreach_batch", trigger="availableNow",
                foreach_batch=lambda b, i: update_user_state(b, state, i),
                checkpoint=os.path.join(scratch, "ck_state")))
    got = read_user_state(spark, state)
    want = E.queries()["user_state_update"](spark, SF_SMALL)
    assert rows(got) == rows(want)


def test_archive_stream(spark, tables, scratch):
    d = os.path.join(scratch, "arch_in")
    logs = tables.app_logs()
    write_replay(logs, d, "seq", 2, fmt="parquet")
    s = open_stream(spark, path=d, fmt="parquet", schema=logs.schema)
    out = os.path.join(scratch, "arch_out")
    drain(start(dau.raw_log_archive(s), "s_arch", sink="text", path=out, partition_by=["dt"],
                trigger="availableNow", checkpoint=os.path.join(scratch, "ck_arch")))
    stored = spark.read.text(out)
    assert rows(stored.select("value")) == rows(logs.select("value"))
    days = dau.raw_log_archive(logs).select("dt").distinct().count()
    assert stored.select("dt").distinct().count() == days


def test_log_route_stream_to_topic_folders(spark, tables, scratch):
    d = os.path.join(scratch, "route_in")
    logs = tables.app_logs()
    write_replay(logs, d, "seq", 2, fmt="parquet")
    s = open_stream(spark, path=d, fmt="parquet", schema=logs.schema)
    out = os.path.join(scratch, "route_out")
    drain(start(dau.log_route(s).select("topic", "value"), "s_route", sink="text", path=out,
                partition_by=["topic"], trigger="availableNow",
                checkpoint=os.path.join(scratch, "ck_route")))
    got = spark.read.text(out)
    assert rows(got.select("topic", "value")) == rows(dau.log_route(logs).select("topic", "value"))


def test_one_query_cap_to_province(spark, tables, scratch):
    d = os.path.join(scratch, "clicks1")
    write_replay(_csv_lines(tables.ad_clicks()), d, "seq", N_FILES)
    spark.createDataFrame([(f"0,0,ZZ,ZZ,{SENTINEL_SEC},{SENTINEL_SEQ}",)], "value string") \
        .coalesce(1).write.mode("append").text(d)
    clicks = scans.good(scans.parse_ad_click_lines(
        open_stream(spark, path=d, fmt="text", max_files_per_trigger=1)))
    got = _run(jobs.ad_clicks_by_province_one_query(clicks, cap=2), "s_prov1", scratch)
    assert rows(got) == rows(E.queries()["ad_clicks_by_province"](spark, SF_SMALL))


def test_one_query_uv_running(spark, tables, behavior_dir, scratch):
    s = jobs.uv_running_one_query(_behavior_stream(spark, behavior_dir), 63)
    got = _run(s, "s_uv_one", scratch).where(F.col("ts_sec") < SENTINEL_SEC)
    assert rows(got) == rows(bh.uv_running(tables.behaviors(), 63))


# ---- rows that arrive late ------------------------------------------------------

DAY = 1_704_067_200   # 2024-01-01


def _files(spark, d, batches, schema):
    """One file, and so one micro-batch, per list of rows."""
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(d)


def _stream(spark, d, schema):
    return open_stream(spark, path=d, fmt="parquet", schema=spark.createDataFrame([], schema).schema,
                       max_files_per_trigger=1)


BEHAVIOR = "user_id long, item_id long, category_id int, behavior string, ts_sec long, seq long"
CLICK = "user_id long, ad_id long, province string, city string, ts_sec long, seq long"


def _late_clicks():
    """Four batches; the third and fourth hold rows older than the ones before."""
    return [[(1, 1, "a", "x", DAY + 100, 1), (1, 1, "a", "x", DAY + 200, 2)],
            [(2, 1, "b", "x", DAY + 50_000, 3), (3, 1, "b", "x", DAY + 86_400 + 10, 4)],
            [(4, 1, "a", "x", DAY + 300, 5), (1, 1, "a", "x", DAY + 400, 6)],
            [(1, 1, "a", "x", DAY + 500, 7), (5, 2, "b", "x", DAY + 60, 8)]]


def _app_log(seq, mid, sec):
    return (seq, '{"common":{"mid":"%s","uid":"u","ar":"1","ch":"c","vc":"v"},"start":{},"ts":%d}'
            % (mid, sec * 1000))


def _late_logs():
    return [[_app_log(1, "m1", DAY + 100)], [_app_log(2, "m2", DAY + 80_000),
                                             _app_log(3, "m1", DAY + 86_500)],
            [_app_log(4, "m3", DAY + 5), _app_log(5, "m2", DAY + 7)],
            [_app_log(6, "m4", DAY + 50), _app_log(7, "m1", DAY + 90)]]


def _late_views():
    def v(user, sec, seq):
        return (user, 1, 1, "pv", DAY + sec, seq)
    return [[v(1, 100, 1), v(2, 3500, 2)], [v(3, 3700, 3)], [v(4, 50, 4), v(1, 60, 5)],
            [v(5, 3599, 6), v(3, 3601, 7)]]


@pytest.mark.parametrize("restarts", [1, 4])
def test_late_clicks_are_capped_like_the_batch(spark, scratch, restarts):
    d, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    batches = _late_clicks()

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    step = len(batches) // restarts
    for i in range(0, len(batches), step):   # each round resumes from the checkpoint
        _files(spark, d, batches[i:i + step], CLICK)
        q = start(jobs.ad_click_outcomes_stream(_stream(spark, d, CLICK), cap=2), f"late_cap_{restarts}_{i}",
                  sink="foreach_batch", foreach_batch=write, trigger="availableNow", checkpoint=ck)
        drain(q)
        assert late_rows(q) == 0
    passed, warns = jobs.split_ad_outcomes(spark.read.parquet(out))
    clicks = spark.createDataFrame([r for b in batches for r in b], CLICK)
    assert rows(passed) == rows(ads.ad_click_cap(clicks, 2))
    assert rows(warns) == rows(ads.ad_click_warnings(clicks, 2))


@pytest.mark.parametrize("restarts", [1, 4])
def test_late_devices_count_like_the_batch(spark, scratch, restarts):
    d, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    batches, schema = _late_logs(), "seq long, value string"
    step = len(batches) // restarts
    for i in range(0, len(batches), step):
        _files(spark, d, batches[i:i + step], schema)
        q = start(jobs.dau_first_stream(_stream(spark, d, schema)), f"late_dau_{restarts}_{i}",
                  path=out, trigger="availableNow", checkpoint=ck)
        drain(q)
        assert late_rows(q) == 0
    logs = spark.createDataFrame([r for b in batches for r in b], schema)
    assert rows(spark.read.parquet(out), ["dt", "mid"]) == rows(dau.dau_first(logs), ["dt", "mid"])


@pytest.mark.parametrize("restarts", [1, 4])
def test_late_visitors_count_like_the_batch(spark, scratch, restarts):
    d, firsts, ck = (os.path.join(scratch, x) for x in ("in", "firsts", "ck"))
    batches = _late_views()
    step = len(batches) // restarts
    for i in range(0, len(batches), step):
        _files(spark, d, batches[i:i + step], BEHAVIOR)
        q = start(jobs.uv_first_offsets_stream(_stream(spark, d, BEHAVIOR)), f"late_uv_{restarts}_{i}",
                  path=firsts, trigger="availableNow", checkpoint=ck)
        drain(q)
        assert late_rows(q) == 0
    first_schema = spark.read.parquet(firsts).schema
    s2 = jobs.uv_running_stream(spark.readStream.schema(first_schema).parquet(firsts))
    got = _run(s2, f"late_uv2_{restarts}", scratch)
    views = spark.createDataFrame([r for b in batches for r in b], BEHAVIOR)
    want = bh.uv_running(views)
    for key in (["window_end", "count"], ["window_end", "user_id"]):
        assert rows(got, key) == rows(want, key)


def test_one_query_forms_accept_late_rows(spark, scratch):
    d, v = os.path.join(scratch, "clicks"), os.path.join(scratch, "views")
    far = 10 * 86_400
    _files(spark, d, _late_clicks() + [[(0, 0, "z", "z", DAY + far, 99)]], CLICK)
    got = _run(jobs.ad_clicks_by_province_one_query(_stream(spark, d, CLICK), cap=2), "late_one", scratch)
    clicks = spark.createDataFrame([r for b in _late_clicks() for r in b], CLICK)
    assert rows(got) == rows(ads.ad_clicks_by_province(ads.ad_click_cap(clicks, 2)))
    _files(spark, v, _late_views() + [[(0, 0, 0, "pv", DAY + far, 99)]], BEHAVIOR)
    got = _run(jobs.uv_running_one_query(_stream(spark, v, BEHAVIOR)), "late_uv_one", scratch)
    want = bh.uv_running(spark.createDataFrame([r for b in _late_views() for r in b], BEHAVIOR))
    got = got.where(F.col("ts_sec") < DAY + far)
    for key in (["window_end", "count"], ["window_end", "user_id"]):
        assert rows(got, key) == rows(want, key)


@pytest.mark.parametrize("name,batch", [
    ("pv_hourly_salted", bh.pv_hourly), ("uv_hourly", bh.uv_hourly),
    ("uv_hourly_bitmap", bh.uv_hourly_bitmap), ("uv_hourly_approx", bh.uv_hourly_approx)])
def test_hourly_counts_take_a_delay(spark, scratch, name, batch):
    d, far = os.path.join(scratch, "in"), 10 * 86_400
    _files(spark, d, _late_views() + [[(0, 0, 0, "pv", DAY + far, 99)]], BEHAVIOR)
    s = getattr(jobs, f"{name}_stream")(_stream(spark, d, BEHAVIOR), delay="2 hours")
    got = _run(s, f"delay_{name}", scratch).where(F.col("window_end") < (DAY + far) * 1000)
    views = spark.createDataFrame([r for b in _late_views() for r in b], BEHAVIOR)
    assert rows(got) == rows(batch(views))


def test_marketing_takes_a_delay(spark, scratch):
    d, far, schema = os.path.join(scratch, "in"), 10 * 86_400, "channel string, behavior string, ts_ms long"
    batches = [[("a", "CLICK", DAY * 1000)], [("a", "CLICK", (DAY + 7000) * 1000)],
               [("a", "CLICK", (DAY + 1) * 1000), ("b", "CLICK", (DAY + 100) * 1000)]]
    _files(spark, d, batches + [[("z", "CLICK", (DAY + far) * 1000)]], schema)
    s = jobs.marketing_by_channel_stream(_stream(spark, d, schema), slide="5 minutes", delay="3 hours")
    got = _run(s, "delay_marketing", scratch).where("channel <> 'z'")
    want = collections.Counter()
    for channel, behavior, ms in (r for b in batches for r in b):
        first = ms // 300_000 * 300_000 + 300_000
        for k in range(12):
            want[channel, behavior, first + k * 300_000] += 1
    assert rows(got) == sorted(((*k, n) for k, n in want.items()), key=repr)


def test_rows_beyond_the_delay_are_counted(spark, scratch):
    d = os.path.join(scratch, "in")
    batches = [[(1, 1, "a", "x", DAY, 1)], [(1, 1, "a", "x", DAY + 5 * 86_400, 2)],
               [(3, 1, "a", "x", DAY + 5 * 86_400, 5)],
               [(1, 1, "a", "x", DAY + 1, 3), (2, 1, "a", "x", DAY + 5 * 86_400, 4)]]
    _files(spark, d, batches, CLICK)
    q = start(jobs.ad_click_outcomes_stream(_stream(spark, d, CLICK), cap=2), "beyond", sink="memory",
              trigger="availableNow", checkpoint=os.path.join(scratch, "ck"))
    drain(q)
    assert late_rows(q) == 1 and spark.table("beyond").count() == 4


# ---- sinks ----------------------------------------------------------------------

def test_a_failed_read_leaves_the_store_alone(spark, scratch, monkeypatch):
    from clickflow.sinks import update_user_state, writers
    docs, state = os.path.join(scratch, "docs"), os.path.join(scratch, "state")
    schema = "id string, dt string"
    upsert_docs(spark.createDataFrame([("d_a", "2024-01-01"), ("d_b", "2024-01-01")], schema), docs, 0)
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    update_user_state(users, state, 0)

    def broken(*_):
        raise OSError("listing failed")

    with monkeypatch.context() as m:
        m.setattr(writers, "path_exists", broken)
        new = spark.createDataFrame([("d_c", "2024-01-01")], schema)
        for call in (lambda: upsert_docs(new, docs, 1), lambda: update_user_state(users, state, 1)):
            with pytest.raises(OSError):
                call()
    assert rows(spark.read.parquet(docs), ["id"]) == [("d_a",), ("d_b",)]
    assert rows(writers.read_user_state(spark, state)) == [(1, "1"), (2, "1")]
    upsert_docs(new, docs, 1)
    upsert_docs(new, docs, 1)
    assert rows(spark.read.parquet(docs), ["id"]) == [("d_a",), ("d_b",), ("d_c",)]
    writers.compact(spark, docs, os.path.join(scratch, "small"), new.schema, ["dt"])
    assert spark.read.parquet(os.path.join(scratch, "small")).count() == 3


def test_topic_replay_keys_and_console(spark, scratch):
    from clickflow.sinks import replay_file_to_topic, write_topic
    src, topics, keyed = (os.path.join(scratch, x) for x in ("src", "topics", "keyed"))
    spark.createDataFrame([("a",), ("b",), ("a",)], "value string").write.text(src)
    replay_file_to_topic(spark, src, "lines", path=topics)
    assert rows(spark.read.text(topics), ["topic", "value"]) == \
        [("lines", "a"), ("lines", "a"), ("lines", "b")]
    write_topic(spark.createDataFrame([("t", "k1", "v1"), ("t", None, "v2")],
                                      "topic string, key string, value string"), path=keyed)
    back = spark.read.schema("topic string, key string, value string").json(keyed)
    assert rows(back, ["topic", "key", "value"]) == [("t", "k1", "v1"), ("t", None, "v2")]
    s = spark.readStream.schema("value string").text(src)
    drain(start(s, "console", sink="console", trigger="availableNow",
                checkpoint=os.path.join(scratch, "ck")))


def test_interval_trigger_reads_files_as_they_come(spark, scratch):
    import time
    d, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    schema = "value string"
    _files(spark, d, [[("a",)]], schema)
    q = start(_stream(spark, d, schema), "every_second", path=out, trigger="1 second",
              checkpoint=os.path.join(scratch, "ck"))
    try:
        q.processAllAvailable()
        _files(spark, d, [[("b",)], [("c",)]], schema)
        deadline = time.time() + 60
        while spark.read.schema(schema).parquet(out).count() < 3 and time.time() < deadline:
            time.sleep(0.5)
    finally:
        q.stop()
    assert rows(spark.read.parquet(out)) == [("a",), ("b",), ("c",)]


def test_topic_sequence_orders_by_partition_and_offset(spark):
    from clickflow.streaming.sources import topic_seq
    df = spark.createDataFrame([(1, 0), (0, 2 ** 40), (0, 5), (30_000, 7)], "partition int, offset long")
    got = [(r.partition, r.offset) for r in df.orderBy(topic_seq("partition", "offset")).collect()]
    assert got == [(0, 5), (0, 2 ** 40), (1, 0), (30_000, 7)]
    assert df.select(F.max(topic_seq("partition", "offset"))).first()[0] < bh.SEQ_SPAN
