"""Tables that batches add to: bitmaps, totals, applied changes, the offset ledger."""

import json
import os
import random

from pyspark.sql import functions as F

import __spark_entry__ as E
from clickflow.operators import behavior as bh, bitmaps, cdc, dau
from clickflow.plans.tables import Tables
from clickflow.session import sub_dir
from clickflow.sinks import Store, docs_store, upsert_docs
from clickflow.streaming import apps, jobs, ledger
from clickflow.streaming.run import drain, start
from clickflow.streaming.sources import open_stream
from conftest import SF_SMALL, rows


# ---- bitmaps ------------------------------------------------------------------

def test_stored_bitmaps_merge_like_one_pass(spark, scratch):
    b = Tables(spark, SF_SMALL).behaviors()
    store = Store(spark, scratch, bitmaps.BITMAPS)
    for i in range(3):
        part = b.where(F.col("seq") % 3 == i)
        store.append(bitmaps.uv_bitmaps(part, 1023), i)
        store.append(bitmaps.uv_bitmaps(part, 1023), i)      # a replay
        if i == 1:
            store.compact()
    got = bitmaps.uv_rollup(store.read())
    assert rows(got) == rows(bitmaps.uv_rollup(bitmaps.uv_bitmaps(b, 1023)))
    hours = got.where("grain = 'hour'").select((F.col("period") + 3_600_000).alias("window_end"), "count")
    assert rows(hours) == rows(bh.uv_hourly_bitmap(b, 1023), ["window_end", "count"])
    users = bh.with_offset(bh.page_views_exact(b), 1023)
    assert got.where("grain = 'all'").first()["count"] == users.select("offset").distinct().count()


def test_bitmaps_by_hand(spark):
    rows_in = [(u, 1, 1, "pv", ts, i) for i, (u, ts) in enumerate(
        [(1, 0), (1, 10), (2, 3599), (1, 3600), (3, 86_400), (1, -1), (None, 5)])]
    b = spark.createDataFrame(rows_in, "user_id long, item_id long, category_id int, behavior string, ts_sec long, seq long")
    got = {(r.grain, r.period): r["count"] for r in bitmaps.uv_rollup(
        bitmaps.uv_bitmaps(b.where("user_id is not null"))).collect()}
    hour, day = 3_600_000, 86_400_000
    assert got == {("hour", 0): 2, ("hour", hour): 1, ("hour", day): 1, ("hour", -hour): 1,
                   ("day", 0): 2, ("day", day): 1, ("day", -day): 1, ("all", 0): 3}
    assert bitmaps.uv_rollup(bitmaps.uv_bitmaps(b.limit(0))).count() == 0


# ---- dashboard totals ------------------------------------------------------------

def test_totals_from_deltas_after_late_rows_and_a_replay(spark, scratch):
    docs = E.queries()["dau_docs"](spark, SF_SMALL).cache()
    path, totals = os.path.join(scratch, "docs"), os.path.join(scratch, "totals")
    late = F.pmod(F.xxhash64("id"), F.lit(3))
    for n, part in enumerate([docs.where(late == 0), docs.where(late < 2), docs]):
        for _ in range(2 if n == 1 else 1):                  # batch 1 runs twice
            upsert_docs(part, path, n)
            apps.add_totals(spark, path, docs.schema, totals, n)
        if n == 1:
            docs_store(spark, path, docs.schema).compact()
            apps.totals_store(spark, totals).compact()
            upsert_docs(part, path, n)                       # and once more, compacted
            apps.add_totals(spark, path, docs.schema, totals, n)
    store = apps.totals_store(spark, totals)
    assert rows(dau.by_hour_from_deltas(store.read())) == rows(dau.dau_by_hour(docs))
    assert rows(dau.total_from_deltas(store.read())) == rows(dau.dau_total(docs))
    day = docs.first().dt
    one = store.read(values=[day])
    assert all(f"dt={day}" in f for f in one.inputFiles())
    assert rows(dau.total_from_deltas(one)) == rows(dau.dau_total(docs.where(F.col("dt") == day)))
    docs.unpersist()


# ---- applied changes ---------------------------------------------------------------

def envelope(table, kind, ts, xid, data):
    return (json.dumps({"table": table, "type": kind, "ts": ts, "xid": xid, "data": data}),)


def test_changes_equal_a_replay(spark, scratch):
    r = random.Random(6)
    kinds = ["insert", "update", "delete", "UPDATE"]
    log = [(f"t{r.randrange(2)}", r.choice(kinds), r.randrange(6), x, {"id": r.randrange(8), "v": x})
           for x in range(150)]
    want = {}
    for table, kind, ts, xid, data in sorted(log, key=lambda c: (c[2], c[3])):
        want[table, str(data["id"])] = None if kind == "delete" else (ts, xid, json.dumps(data, separators=(",", ":")))
    want = {k: v for k, v in want.items() if v}
    sent = log + r.sample(log, 40)
    r.shuffle(sent)
    sent = [envelope(*c) for c in sent] + [("{broken",), (None,), envelope("t0", "insert", 99, 1, None),
                                           envelope("t0", "insert", 99, 1, {"v": 1}), ('{"table":"t0"}',)]

    def live(latest):
        return {(x.table, x.key): (x.ts, x.seq, json.dumps(json.loads(x.value), separators=(",", ":")))
                for x in cdc.live_rows(latest).collect()}

    df = spark.createDataFrame(sent, "value string")
    assert live(cdc.latest_changes(cdc.changes(df))) == want
    # batch by batch, into a store whose compaction keeps one row a key
    store = Store(spark, scratch, cdc.CHANGES)
    for n in range(4):
        part = spark.createDataFrame(sent[n * 50:(n + 1) * 50] or [("x",)], "value string")
        store.append(cdc.latest_changes(cdc.changes(part)), n)
        if n == 2:
            store.compact(cdc.latest_changes)
            assert store.read().count() == store.read().select("table", "key").distinct().count()
    assert live(cdc.latest_changes(store.read().drop("batch_id"))) == want


# ---- the ledger ----------------------------------------------------------------------

def test_ledger_records_committed_batches(spark, scratch):
    src, path = os.path.join(scratch, "in"), os.path.join(scratch, "ledger")
    schema = "ts_sec long, url string"
    listener = ledger.Ledger(spark, path, ["ledgered"])
    spark.streams.addListener(listener)
    checkpoint = sub_dir(spark, "streams", "ledgered")

    def run(n, ts):
        spark.createDataFrame([(t, "u") for t in ts], schema).coalesce(1).write.mode("append").parquet(src)
        s = open_stream(spark, path=src, fmt="parquet", schema=spark.read.parquet(src).schema)
        counts = jobs.with_event_time(s).groupBy(F.window("ts", "10 seconds"), "url").count()
        drain(start(counts, "ledgered", sink="parquet", path=os.path.join(scratch, "out"),
                    trigger="availableNow"))
        # progress reaches listeners a moment after the batch
        import time
        for _ in range(100):
            if ledger.read_ledger(spark, path, "ledgered").where(F.col("batch_id") >= n).count():
                break
            time.sleep(0.2)

    try:
        run(0, [100, 105])
        run(1, [200])
        run(2, [50, 60, 210])         # after a restart; two rows are late
        commits = {int(f) for f in os.listdir(os.path.join(checkpoint.replace("file:", ""), "commits")) if f.isdigit()}
        deadline = 50
        while deadline and {r.batch_id for r in ledger.read_ledger(spark, path, "ledgered").collect()} != commits:
            import time
            time.sleep(0.2)
            deadline -= 1
    finally:
        spark.streams.removeListener(listener)
    got = ledger.read_ledger(spark, path, "ledgered").collect()
    assert {r.batch_id for r in got} == commits
    assert ledger.late_total(spark, path, "ledgered") == 2
    assert sum(r.input_rows for r in got) == 6
    by_batch = sorted((r.batch_id, r.start_offset, r.end_offset) for r in got)
    assert all(a[2] == b[1] for a, b in zip(by_batch, by_batch[1:]))
    # a ledger that missed batches is filled from the checkpoint
    other = os.path.join(scratch, "other")
    assert ledger.fill(spark, other, "ledgered", checkpoint) == len(commits)
    assert ledger.fill(spark, other, "ledgered", checkpoint) == 0
    filled = ledger.read_ledger(spark, other, "ledgered")
    assert sorted((r.batch_id, json.loads(r.end_offset)) for r in filled.collect()) == [
        (b, json.loads(e)) for b, _, e in by_batch]


def test_topic_offsets(spark, scratch):
    a, b = '{"logs":{"0":5,"1":7}}', '{"logs":{"0":9,"1":7,"2":1}}'
    got = ledger._rows("q", "kafka", a, b, 6, 2)
    assert got == [("q", "kafka", "logs", 0, "5", "9", 6, 2), ("q", "kafka", "logs", 1, "7", "7", 0, 0),
                   ("q", "kafka", "logs", 2, None, "1", 0, 0)]
    s = ledger.ledger_store(spark, scratch, "q")
    s.append(spark.createDataFrame(ledger._rows("q", "kafka", None, a, 12, 0), ledger.LEDGER), 0)
    s.append(spark.createDataFrame(got, ledger.LEDGER), 1)
    assert json.loads(ledger.starting_offsets(spark, scratch, "q")) == {"logs": {"0": 9, "1": 7, "2": 1}}
    assert ledger.late_total(spark, scratch, "q") == 2
    assert ledger._offsets("null") == {} and ledger._offsets('{"logOffset":3}') == {(None, None): '{"logOffset":3}'}
