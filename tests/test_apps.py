"""End-to-end streaming apps (E1, E3, E4) against the batch queries."""

import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from clickflow.operators import dau
from clickflow.operators.orders import order_first_flag
from clickflow.plans.tables import Tables
from clickflow.session import sub_dir
from clickflow.sinks import init_user_state, read_user_state
from clickflow.sources import scans
from clickflow.streaming import apps
from clickflow.streaming.run import drain
from clickflow.streaming.sources import open_stream
from replay import write_replay
from conftest import SF_SMALL, rows

SENTINEL_MS = 4_102_444_800_000


def test_dau_app_docs_and_archive(spark, scratch):
    t = Tables(spark, SF_SMALL)
    logs = t.app_logs()
    src = os.path.join(scratch, "logs")
    write_replay(logs, src, "seq", 3, fmt="parquet")
    sentinel = ('{"common":{"mid":"zz","uid":"0","ar":"0","ch":"x","vc":"v0"},'
                '"start":{},"ts":%d}' % SENTINEL_MS)
    spark.createDataFrame([(10 ** 12, sentinel)], logs.schema).write.mode("append").parquet(src)
    stream = open_stream(spark, path=src, fmt="parquet", schema=logs.schema,
                         max_files_per_trigger=1)
    docs, arch = os.path.join(scratch, "docs"), os.path.join(scratch, "arch")
    for q in apps.dau_app(stream, docs, arch, trigger="availableNow", name="app_dau"):
        drain(q)
    want = E.queries()["dau_docs"](spark, SF_SMALL)
    got = spark.read.schema(want.schema).parquet(docs).where("mid <> 'zz'")
    assert rows(got, ["id"]) == rows(want, ["id"])
    total = dau.dau_total(spark.read.schema(want.schema).parquet(docs), dt="2024-01-02")
    assert rows(total) == rows(E.queries()["dau_total"](spark, SF_SMALL).where("dt = '2024-01-02'"))
    assert spark.read.text(arch).count() == logs.count() + 1


def test_cdc_then_order_app(spark, scratch):
    t = Tables(spark, SF_SMALL)
    env = t.cdc_object().withColumn("seq", F.monotonically_increasing_id())
    src = os.path.join(scratch, "env")
    write_replay(env, src, "seq", 1, fmt="parquet")
    topics = os.path.join(scratch, "topics")
    drain(apps.cdc_app(open_stream(spark, path=src, fmt="parquet", schema=env.schema), topics,
                       trigger="availableNow", name="app_cdc"))
    assert rows(spark.read.text(topics)) == rows(E.queries()["cdc_split_object"](spark, SF_SMALL)
                                                .select("value", "topic"))
    state = os.path.join(scratch, "state")
    init_user_state(t.user_state(), state)
    out = os.path.join(scratch, "enriched")
    drain(apps.order_app(apps.order_values_from_topics(spark, topics), state, t.province_dim(),
                         t.user_dim(), out, trigger="availableNow", name="app_orders"))
    got = spark.read.parquet(out)
    assert rows(got.select("id", "user_id", "if_first_order")) == \
        rows(E.queries()["order_first_flag_batch"](spark, SF_SMALL))
    assert rows(got.select("id", "province_id", "province_name", "province_area_code",
                           "province_iso_code")) == \
        rows(E.queries()["order_with_province"](spark, SF_SMALL))
    assert rows(read_user_state(spark, state)) == \
        rows(E.queries()["user_state_update"](spark, SF_SMALL))


def test_hot_items_app(spark, scratch):
    t = Tables(spark, SF_SMALL)
    b = t.behaviors()
    src = os.path.join(scratch, "beh")
    lines = b.select(F.concat_ws(",", *[F.col(c).cast("string") for c in b.columns]).alias("value"),
                     "seq")
    write_replay(lines, src, "seq", 3)
    spark.createDataFrame([(f"0,0,0,pv,{SENTINEL_MS // 1000},{10 ** 12}",)], "value string") \
        .coalesce(1).write.mode("append").text(src)
    stream = scans.good(scans.parse_behavior_lines(
        open_stream(spark, path=src, fmt="text", max_files_per_trigger=1)))
    out = os.path.join(scratch, "hot")
    drain(apps.hot_items_app(stream, out, trigger="availableNow", name="app_hot"))
    got = spark.read.parquet(out).drop("batch_id")
    assert rows(got) == rows(E.queries()["hot_items"](spark, SF_SMALL))


def test_ad_app(spark, scratch):
    t = Tables(spark, SF_SMALL)
    c = t.ad_clicks()
    src = os.path.join(scratch, "clicks")
    lines = c.select(F.concat_ws(",", *[F.col(x).cast("string") for x in c.columns]).alias("value"),
                     "seq")
    write_replay(lines, src, "seq", 3)
    spark.createDataFrame([(f"0,0,ZZ,ZZ,{SENTINEL_MS // 1000},{10 ** 12}",)], "value string") \
        .coalesce(1).write.mode("append").text(src)
    stream = scans.good(scans.parse_ad_click_lines(
        open_stream(spark, path=src, fmt="text", max_files_per_trigger=1)))
    out = os.path.join(scratch, "ads")
    drain(apps.ad_app(stream, out, cap=2, trigger="availableNow", name="app_ads"))
    drain(apps.ad_province_app(spark, out, trigger="availableNow", name="app_ads_province"))
    assert rows(spark.read.parquet(f"{out}/by_province")) == \
        rows(E.queries()["ad_clicks_by_province"](spark, SF_SMALL))
    assert rows(spark.read.parquet(f"{out}/warnings").drop("batch_id")) == \
        rows(E.queries()["ad_click_warnings"](spark, SF_SMALL))


def test_order_app_from_empty_state_over_three_batches(spark, scratch):
    """Three micro-batches and no state: each user's earliest order is the
    first one; the last batch run again flags the same; bad records are kept."""
    t = Tables(spark, SF_SMALL)
    values = t.order_json().orderBy("id").collect()
    orders = [(r.id, r.value) for r in values]
    # a user's orders come in time order over the batches
    times = {r.id: r.create_time for r in scans.good(scans.decode_orders(
        spark.createDataFrame(orders, "id long, value string"))).select("id", "create_time").collect()}
    orders.sort(key=lambda o: (times[o[0]], o[0]))
    third = len(orders) // 3 + 1
    src, out, state, bad = (os.path.join(scratch, x) for x in ("in", "out", "state", "bad"))
    for i in range(3):
        part = [(v,) for _, v in orders[i * third:(i + 1) * third]] + [("{broken",)]
        spark.createDataFrame(part, "value string").coalesce(1).write.mode("append").text(src)

    def run():
        stream = open_stream(spark, path=src, fmt="text", max_files_per_trigger=1)
        drain(apps.order_app(stream, state, t.province_dim(), t.user_dim(), out, name="app_orders3",
                             trigger="availableNow", buckets=4, bad_path=bad))

    run()
    none = spark.createDataFrame([], "user_id long, if_consumed string")
    want = rows(order_first_flag(spark_orders(spark, orders), none, within_batch=True),
                ["id", "user_id", "if_first_order"])
    key = ["id", "user_id", "if_first_order"]
    assert rows(spark.read.parquet(out), key) == want
    assert spark.read.parquet(bad).count() == 3
    consumed = rows(read_user_state(spark, state))
    # a crash after the state was written: the last batch's commit is missing
    commit = os.path.join(sub_dir(spark, "streams", "app_orders3").replace("file:", ""), "commits", "2")
    for f in (commit, os.path.join(os.path.dirname(commit), ".2.crc")):
        if os.path.exists(f):
            os.remove(f)
    run()
    assert rows(spark.read.parquet(out), key) == want
    assert rows(read_user_state(spark, state)) == consumed


def spark_orders(spark, orders):
    return scans.good(scans.decode_orders(spark.createDataFrame(orders, "id long, value string")))
