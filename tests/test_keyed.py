"""Keyed-state streams: equal to the batch forms, over restarts, replays and disorder."""

import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from clickflow.operators import behavior as bh, marketing
from clickflow.operators.orders import order_first_flag
from clickflow.plans.tables import Tables
from clickflow.session import sub_dir
from clickflow.sources import scans
from clickflow.streaming import apps, jobs, keyed
from clickflow.streaming.run import drain, start
from clickflow.streaming.sources import open_stream
from replay import write_replay
from conftest import SF_SMALL, rows

SENTINEL_SEC = 4_102_444_800


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF_SMALL)


def files(spark, d, batches, schema):
    """One file a batch, read one a micro-batch."""
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(d)
    return lambda: open_stream(spark, path=d, fmt="parquet", schema=spark.read.parquet(d).schema,
                               max_files_per_trigger=1)


def forget_commit(checkpoint, batch):
    """As after a crash at the end of a batch: its commit is missing."""
    folder = os.path.join(checkpoint.replace("file:", ""), "commits")
    for f in (str(batch), f".{batch}.crc"):
        if os.path.exists(os.path.join(folder, f)):
            os.remove(os.path.join(folder, f))


# ---- first orders -----------------------------------------------------------

def test_first_orders_over_batches_restart_and_replay(spark, tables, scratch):
    times = {r.id: r.create_time for r in scans.good(scans.decode_orders(tables.order_json()))
             .select("id", "create_time").collect()}
    orders = sorted(((r.id, r.value) for r in tables.order_json().collect()),
                    key=lambda o: (times[o[0]], o[0]))
    src, out, bad = (os.path.join(scratch, x) for x in ("in", "out", "bad"))
    third = len(orders) // 3 + 1

    def add(i):
        part = [(v,) for _, v in orders[i * third:(i + 1) * third]] + [("{broken",)]
        spark.createDataFrame(part, "value string").coalesce(1).write.mode("append").text(src)

    def run():
        stream = open_stream(spark, path=src, fmt="text", max_files_per_trigger=1)
        qs = apps.order_state_app(stream, tables.province_dim(), tables.user_dim(), out,
                                  user_state=tables.user_state(), bad_path=bad,
                                  name="order_state", trigger="availableNow")
        for q in qs:
            drain(q)
        return qs[0]

    add(0)
    add(1)
    run()
    add(2)                 # a restart, then another batch
    run()
    want = rows(E.queries()["order_first_flag_batch"](spark, SF_SMALL))
    key = ["id", "user_id", "if_first_order"]
    assert rows(spark.read.parquet(out), key) == want
    assert rows(spark.read.parquet(out).select("id", "province_name"))[0] is not None
    checkpoint = sub_dir(spark, "streams", "order_state")
    state = rows(keyed.consumed_users(spark, checkpoint))
    assert state == rows(E.queries()["user_state_update"](spark, SF_SMALL).where("user_id is not null"))
    forget_commit(checkpoint, 2)
    q = run()
    assert rows(spark.read.parquet(out), key) == want
    assert rows(keyed.consumed_users(spark, checkpoint)) == state
    assert spark.read.text(bad).count() == 3
    # a batch reads its own source rows and the two dimensions, no stored rows
    assert all(src in s["description"] for p in q.recentProgress for s in p["sources"])


def test_first_orders_small(spark, scratch):
    schema = "id long, user_id long, create_time string, big long, if_first_order string"
    b0 = [(1, 7, "2024-01-02", None, "x"), (2, 7, "2024-01-01", 2 ** 60 + 1, "x"), (3, 8, "a", 1, None),
          (4, None, "a", 2, None), (2, 7, "2024-01-01", 5, None), (6, 9, None, 1, None), (5, 9, "", 1, None)]
    b1 = [(9, 7, "2023-01-01", 0, None), (10, 9, "0", 0, None), (11, 12, "0", 0, None)]
    stream = files(spark, os.path.join(scratch, "in"), [b0, b1], schema)
    seed = spark.createDataFrame([(8, "1"), (8, "0"), (9, "0"), (None, "1")], "user_id int, if_consumed string")
    out = keyed.first_order_stream(stream(), seed)
    drain(start(out, "first_small", path=os.path.join(scratch, "out"), trigger="availableNow",
                checkpoint=os.path.join(scratch, "ck")))
    got = spark.read.parquet(os.path.join(scratch, "out"))
    want = {1: "0", 2: "1", 3: "0", 4: "0", 5: "0", 6: "1", 9: "0", 10: "0", 11: "1"}
    assert {(r.id, r.if_first_order) for r in got.collect()} == set(want.items())
    assert rows(got, ["id", "big"]) == sorted([(r[0], r[3]) for r in b0 + b1], key=repr)
    batch = order_first_flag(spark.createDataFrame(b0, schema), seed.where("if_consumed = '1'"),
                             within_batch=True)
    assert {(r.id, r.if_first_order) for r in batch.collect()} == {(i, f) for i, f in want.items() if i < 9}


# ---- late rows --------------------------------------------------------------

@pytest.mark.parametrize("window", [False, True])
def test_late_and_on_time_rows_are_the_input(spark, scratch, window):
    r = random.Random(3)
    batches, n, seen = [], 0, []
    for i in range(4):
        b = [(n + j, f"u{r.randrange(5)}", 1_000_000 * i + r.randrange(-900_000, 1_000_000), None)
             for j in range(40)]
        n += 40
        batches.append(b)
    size, slide, delay = (600_000, 60_000, 200_000) if window else (0, 0, 200_000)
    # what the watermark before each batch says, in plain Python
    top, want = 0, {}
    for b in batches:
        wm = max(top - delay, 0) if seen else 0
        for i, _, ms, _ in b:
            closes = ms // slide * slide + size if window else ms
            want[i] = closes <= wm
        seen += [ms for _, _, ms, _ in b]
        top = max(seen)
    d, out = os.path.join(scratch, "in"), os.path.join(scratch, "routed")
    schema = "id long, url string, ts_ms long, note string"

    def run():
        s = open_stream(spark, path=d, fmt="parquet", schema=spark.read.parquet(d).schema,
                        max_files_per_trigger=1)
        routed = keyed.with_late_flag(s, "200 seconds", size, slide)
        drain(apps.route_late_app(routed, out, name=f"late_{window}", trigger="availableNow"))

    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(d)
        if i == 1:
            run()
    run()      # a restart with two more batches
    got = [(x.id, x.late == "true") for x in
           spark.read.parquet(out).withColumn("late", F.col("late").cast("string")).collect()]
    assert set(got) == set(want.items()) and len(got) == n
    assert 0 < sum(want.values()) < n
    parked = apps.parked_rows(spark, out, spark.read.parquet(d).schema).collect()
    assert {x.id for x in parked} == {i for i, late in want.items() if late}
    assert all(x.ts_ms <= x.watermark_ms for x in parked)
    # a query over the on-time rows loses none of them
    on_time = jobs.with_event_time(apps.on_time_rows(spark, out, spark.read.parquet(d).schema), "200 seconds")
    name = f"late_counts_{window}"
    wide = F.window("ts", "600 seconds", "60 seconds") if window else F.window("ts", "1 millisecond")
    q = drain(start(on_time.groupBy(wide.alias("w"), "url").count(), name, sink="memory", mode="complete",
                    trigger="availableNow", checkpoint=os.path.join(scratch, "ck_counts")))
    if not window:
        assert all(o["numRowsDroppedByWatermark"] == 0 for p in q.recentProgress for o in p["stateOperators"])
    last = {(x.url, x.end): x["count"] for x in spark.table(name).select(
        "url", F.unix_millis("w.end").alias("end"), "count").collect()}
    for b in batches:
        for i, url, ms, _ in b:
            if not want[i]:
                assert last[url, ms // slide * slide + size if window else ms + 1] >= 1


# ---- running unique visitors -------------------------------------------------

def shuffled_behaviors(spark, tables, d, disorder_sec, n_files=4):
    """The page views in files, each row moved by up to ``disorder_sec``; a
    far-future row at the end."""
    r = random.Random(1)
    b = [tuple(x) for x in tables.behaviors().collect()]
    names = tables.behaviors().columns
    at = names.index("ts_sec")
    b.sort(key=lambda x: x[at] + r.random() * disorder_sec)
    size = len(b) // n_files + 1
    schema = tables.behaviors().schema
    for i in range(n_files):
        spark.createDataFrame(b[i * size:(i + 1) * size], schema).coalesce(1).write.mode("append").parquet(d)
    last = tuple({"ts_sec": SENTINEL_SEC, "behavior": "pv"}.get(n, 0) for n in names)
    spark.createDataFrame([last], schema).coalesce(1).write.mode("append").parquet(d)
    return lambda: open_stream(spark, path=d, fmt="parquet", schema=schema, max_files_per_trigger=1)


def test_running_uv_equals_batch_under_disorder(spark, tables, scratch):
    span = tables.behaviors().agg(F.max("ts_sec") - F.min("ts_sec")).first()[0]
    stream = shuffled_behaviors(spark, tables, os.path.join(scratch, "in"), span // 20)
    out = os.path.join(scratch, "uv")
    for _ in range(2):       # the second start has nothing to do
        drain(apps.uv_running_app(stream(), out, mask=63, delay=f"{span // 10} seconds",
                                  name="uv_running_app", trigger="availableNow"))
    forget_commit(sub_dir(spark, "streams", "uv_running_app"), 3)
    drain(apps.uv_running_app(stream(), out, mask=63, delay=f"{span // 10} seconds",
                              name="uv_running_app", trigger="availableNow"))
    got = apps.read_uv_running(spark, out).where(F.col("ts_sec") < SENTINEL_SEC)
    assert rows(got) == rows(bh.uv_running(tables.behaviors(), 63).select(*got.columns))


def test_running_uv_spreads_an_hour(spark, scratch):
    """One hour of many visitors in one batch: ranked right, in many tasks."""
    from clickflow.operators.windows import rank_in_group
    n = 1_000_000
    firsts = (spark.range(n).select(
        F.lit(3_600_000).cast("long").alias("window_end"), F.col("id").alias("offset"),
        F.col("id").alias("user_id"), (F.col("id") * 7919 % 3600).alias("ts_sec"), F.col("id").alias("seq")))
    ranked = rank_in_group(firsts, ["window_end"], "ts_sec", "seq", "count")
    tasks = ranked.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and max(t["count"] for t in tasks) < 0.6 * n
    s = ranked.agg(F.count_distinct("count"), F.min("count"), F.max("count")).first()
    assert tuple(s) == (n, 1, n)


# ---- marketing ring ----------------------------------------------------------

def test_marketing_ring_equals_batch(spark, tables, scratch):
    events = tables.marketing()
    d = os.path.join(scratch, "in")
    write_replay(events, d, "ts_ms", 3, fmt="parquet")
    last = tuple({"ts_ms": SENTINEL_SEC * 1000}.get(c, 0 if t != "string" else "zz") for c, t in events.dtypes)
    spark.createDataFrame([last], events.schema).coalesce(1).write.mode("append").parquet(d)
    stream = open_stream(spark, path=d, fmt="parquet", schema=events.schema, max_files_per_trigger=1)
    ring = jobs.marketing_ring_stream(stream)
    plan = ring._jdf.queryExecution().analyzed().toString()
    assert plan.count("TransformWithState") == 1 and plan.count("Expand") == 0
    drain(start(ring, "ring", path=os.path.join(scratch, "out"), trigger="availableNow",
                checkpoint=os.path.join(scratch, "ck")))
    got = spark.read.parquet(os.path.join(scratch, "out"))
    assert rows(got) == rows(marketing.marketing_by_channel(events).select(*got.columns))


def test_ring_by_hand(spark, scratch):
    """Gaps, both ends of a window, NULL keys, panes out of order in a batch."""
    slide, size = 5_000, 20_000
    rows_in = [("a", "x", 1_000), ("a", "x", 1_500), ("a", "x", 16_000), ("a", "x", 61_000),
               (None, None, 2_000), ("a", "UNINSTALL", 3_000), ("b", "x", 59_999), ("b", "x", 45_000)]
    schema = "channel string, behavior string, ts_ms long"
    stream = files(spark, os.path.join(scratch, "in"),
                   [rows_in[:3], rows_in[3:6], rows_in[6:], [("z", "z", SENTINEL_SEC * 1000)]], schema)
    drain(start(jobs.marketing_ring_stream(stream(), size, slide, "40 seconds"), "ring_small",
                path=os.path.join(scratch, "out"), trigger="availableNow",
                checkpoint=os.path.join(scratch, "ck")))
    got = spark.read.parquet(os.path.join(scratch, "out"))
    batch = marketing.marketing_by_channel(spark.createDataFrame(rows_in, schema), size, slide)
    assert rows(got) == rows(batch.select(*got.columns))


# ---- top k -------------------------------------------------------------------

def test_hot_items_in_one_plan(spark, tables, scratch):
    stream = shuffled_behaviors(spark, tables, os.path.join(scratch, "in"), 0)
    out = os.path.join(scratch, "out")

    def run():
        top = jobs.hot_items_stream(stream())
        assert "collect_list" not in top._jdf.queryExecution().analyzed().toString()
        drain(start(top, "hot_one", path=out, trigger="availableNow", checkpoint=os.path.join(scratch, "ck")))

    run()
    forget_commit(os.path.join(scratch, "ck"), 2)
    run()
    assert rows(spark.read.parquet(out)) == rows(bh.hot_items(tables.behaviors())
                                                .select("window_end", "rank", "item_id", "count"))
