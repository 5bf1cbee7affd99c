"""Branch cases on hand-made rows, and the scalable helpers against their
brute-force definitions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickflow.functions.time import previous_day_key
from clickflow.operators import behavior as bh
from clickflow.operators import cdc, dau, orders, search
from clickflow.operators.windows import (
    first_in_group, rank_in_group, sliding_counts, sliding_counts_sweep, top_k,
)
from clickflow.sources import scans
from conftest import rows


def _random_events(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", "c", None])
        sec = 1_700_000_000 + rnd.randint(0, 4 * 3600)
        data.append((i, key, sec, sec * 1000 + rnd.randint(0, 999)))
    return spark.createDataFrame(data, "seq long, k string, ts_sec long, ts_ms long")


def test_rank_in_group_equals_row_number(spark):
    df = _random_events(spark)
    got = rank_in_group(df, ["k"], "ts_sec", "seq", "r")
    want = df.withColumn("r", F.row_number().over(
        Window.partitionBy("k").orderBy("ts_sec", "seq")))
    assert rows(got, ["seq", "r"]) == rows(want, ["seq", "r"])
    kept = rank_in_group(df, ["k"], "ts_sec", "seq", "r", materialize=True)
    assert rows(kept, ["seq", "r"]) == rows(want, ["seq", "r"])


def test_sweep_equals_fanout(spark):
    df = _random_events(spark)
    for size, slide, chunk in [(3_600_000, 5_000, None), (600_000, 60_000, 600_000),
                               (300_000, 300_000, None)]:
        fan = sliding_counts(df, ["k"], "ts_ms", size, slide) if size // slide <= 64 else None
        sweep = sliding_counts_sweep(df, ["k"], "ts_ms", size, slide, chunk_ms=chunk)
        brute = (df.select("k", F.explode(F.sequence(
            F.floor(F.col("ts_ms") / slide) + 1, F.floor(F.col("ts_ms") / slide) + size // slide))
            .alias("e")).groupBy("k", (F.col("e") * slide).alias("window_end")).count())
        assert rows(sweep) == rows(brute.select("k", "window_end", "count"))
        if fan is not None:
            assert rows(fan) == rows(sweep)


def test_top_k_ties_by_key(spark):
    df = spark.createDataFrame([(1, 10, 5), (1, 11, 5), (1, 12, 7), (2, 10, 1)],
                               "w long, item long, n long")
    got = top_k(df, ["w"], [F.desc("n"), F.asc("item")], 2)
    assert rows(got, ["w", "item", "rank"]) == [(1, 10, 2), (1, 12, 1), (2, 10, 1)]


def test_pv_case_rules(spark):
    b = spark.createDataFrame([(1, "pv"), (2, "PV"), (3, "Pv"), (4, "buy")],
                              "user_id long, behavior string")
    assert rows(bh.page_views(b), ["user_id"]) == [(1,), (2,), (3,)]
    assert rows(bh.page_views_exact(b), ["user_id"]) == [(1,)]


def test_first_order_flag_branches(spark):
    o = spark.createDataFrame(
        [(1, 10, "2024-01-01 10:00:00"), (2, 11, "2024-01-01 11:00:00"),
         (3, 12, "2024-01-01 12:00:00"), (4, 13, "2024-01-01 09:00:00"),
         (5, 13, "2024-01-01 08:00:00")],
        "id long, user_id long, create_time string")
    st = spark.createDataFrame([(10, "1"), (11, "0"), (13, None)],
                               "user_id long, if_consumed string")
    got = dict(orders.order_first_flag(o, st).select("id", "if_first_order").collect())
    assert got == {1: "0", 2: "1", 3: "", 4: "1", 5: "1"}
    batch = dict(orders.order_first_flag(o, st, within_batch=True)
                 .select("id", "if_first_order").collect())
    assert batch == {1: "0", 2: "1", 3: "1", 4: "0", 5: "1"}
    upd = dict(orders.user_state_update(o, st).collect())
    assert upd == {10: "1", 11: "1", 12: "1", 13: "1"}


def test_order_time_parts(spark):
    o = spark.createDataFrame([(1, "2024-03-05 07:08:09"), (2, "bad")],
                              "id long, create_time string")
    got = rows(orders.order_time_parts(o), ["id", "create_date", "create_hour"])
    assert got == [(1, "2024-03-05", "07"), (2, "bad", None)]


def test_log_route_start_rules(spark):
    logs = spark.createDataFrame(
        [(1, '{"start":{"entry":"icon"},"ts":1}'), (2, '{"start":null,"ts":1}'),
         (3, '{"ts":1}'), (4, '{"start":"","ts":1}')], "seq long, value string")
    got = dict(dau.log_route(logs).select("seq", "topic").collect())
    start, event = dau.START_TOPIC, dau.EVENT_TOPIC
    assert got == {1: start, 2: event, 3: event, 4: start}


def test_dau_first_is_earliest(spark):
    mk = lambda seq, mid, ts: (seq, '{"common":{"mid":"%s","uid":"u","ar":"1","ch":"c","vc":"v"},'
                                    '"start":{},"ts":%d}' % (mid, ts))  # noqa: E731
    day = 1_704_067_200_000
    logs = spark.createDataFrame(
        [mk(1, "m1", day + 500), mk(2, "m1", day + 100), mk(3, "m1", day + 100),
         mk(4, "m2", day + 86_400_000 + 5), mk(5, "m1", day + 86_400_000 + 7)],
        "seq long, value string")
    got = rows(dau.dau_first(logs), ["dt", "mid", "seq"])
    assert got == [("2024-01-01", "m1", 2), ("2024-01-02", "m1", 5), ("2024-01-02", "m2", 4)]
    docs = dau.dau_docs(dau.dau_first(logs))
    assert rows(docs, ["id", "hr", "mi"])[0] == ("2024-01-01_m1", "00", "00")


def test_day_compare_and_previous_day(spark):
    docs = spark.createDataFrame([("2024-02-29", "01"), ("2024-03-01", "01"), ("2024-03-01", "02")],
                                 "dt string, hr string")
    got = rows(dau.dau_day_compare(docs))
    assert ("2024-03-01", "yesterday", "01", 1) in got
    assert ("2024-03-01", "today", "02", 1) in got
    d = spark.range(1).select(previous_day_key(F.lit("20240301")).alias("p")).first().p
    assert d == "20240229"


def test_cdc_null_data_and_explode(spark):
    env = spark.createDataFrame(
        [('{"table":"order_info","data":[{"id":1},{"id":2}]}',),
         ('{"table":"order_info","data":null}',), ('{"table":"x"}',),
         ('{"table":"user_info","data":[]}',)], "value string")
    assert rows(cdc.cdc_split_array(env)) == [("ODS_ORDER_INFO", '{"id":1}'),
                                              ("ODS_ORDER_INFO", '{"id":2}')]
    obj = spark.createDataFrame(
        [('{"table":"order_info","data":{"id":1,"a":"x"}}',), ('{"table":"t","data":null}',)],
        "value string")
    assert rows(cdc.cdc_split_object(obj)) == [("ODS_ORDER_INFO", '{"id":1,"a":"x"}')]


def test_bad_lines_are_flagged_not_fatal(spark):
    lines = spark.createDataFrame([("1,2,3,pv,100",), ("x,2,3,pv,100",), ("1,2",)], "value string")
    p = scans.parse_behavior_lines(lines)
    assert scans.good(p).count() == 1
    assert scans.bad(p).count() == 2
    logs = spark.createDataFrame([("1.2.3.4 u - 17/05/2015:10:05:03 +0000 GET /a",),
                                  ("1.2.3.4 u - 99/05/2015:10:05:03 +0000 GET /a",)], "value string")
    p = scans.parse_access_log_lines(logs)
    assert [r.ts_ms for r in scans.good(p).collect()] == [1431857103000]
    assert scans.bad(p).count() == 1


def test_first_in_group_equals_row_number(spark):
    df = _random_events(spark)
    for k, buckets in [(1, 64), (3, 1), (10, 7)]:
        got = first_in_group(df, ["k"], ["ts_sec", "seq"], k, "r", buckets)
        want = df.withColumn("r", F.row_number().over(
            Window.partitionBy("k").orderBy("ts_sec", "seq"))).where(F.col("r") <= k)
        assert rows(got, ["seq", "r"]) == rows(want, ["seq", "r"])


@pytest.mark.parametrize("panes", [12, 64, 65])
def test_both_window_forms_agree_around_the_switch(spark, panes):
    df = _random_events(spark, 800)
    slide = 60_000
    both = [rows(sliding_counts(df, ["k"], "ts_ms", panes * slide, slide, sweep=s))
            for s in (False, True, None)]
    assert both[0] == both[1] == both[2]


def test_malformed_json_is_quarantined(spark):
    order = '{"id":1,"user_id":2,"create_time":"2024-01-01 00:00:00"}'
    lines = [order, '{"id":', "", None, '{"id":"x"}', '{"user_id":3}', "[1]"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "n int, value string")
    d = scans.decode_orders(df, keep=["n", "value"])
    assert [r.n for r in scans.good(d).collect()] == [0]
    assert sorted((r.n, r.value) for r in scans.bad(d).collect()) == list(enumerate(lines))[1:]
    env = spark.createDataFrame([('{"table":"t","data":{"a":1}}',), ("{oops",), ('{"table":"t"}',)],
                                "value string")
    assert [r.value for r in cdc.bad_envelopes(env).collect()] == ["{oops"]
    assert [r.value for r in cdc.cdc_split_object(env).collect()] == ['{"a":1}']
    logs = spark.createDataFrame([(1, '{"common":{"mid":"m"},"start":{},"ts":1}'), (2, "{x")],
                                 "seq long, value string")
    assert [r.seq for r in dau.bad_app_logs(logs).collect()] == [2]
    assert [r.seq for r in dau.dau_first(logs).collect()] == [1]


def test_dedup_metrics_count_a_missing_device_like_dau_first(spark):
    logs = spark.createDataFrame(
        [(i, '{"common":{%s},"start":{},"ts":5}' % m) for i, m in
         enumerate(['"mid":"a"', '"uid":"u"', '"uid":"v"'])], "seq long, value string")
    m = dau.dedup_metrics(logs).first()
    assert (m.rows_before, m.rows_after) == (3, 2) and dau.dau_first(logs).count() == 2


def test_search_inside_structs_and_by_any_column(spark):
    docs = spark.createDataFrame(
        [(1, "red", "en", 3, [("a", 1)]), (2, "red red", "en", 7, [("b", 2)]),
         (3, "red !", "en", 5, [("a", 3), ("b", 4)]), (4, "red", "en", 3, None)],
        "doc_id long, text string, lang string, n_chars long, parts array<struct<name:string,n:int>>")
    got = search.doc_search(docs, "red", where=search.element_match("parts", "name", "a"),
                            order_by=[F.asc("doc_id")])
    assert [r.doc_id for r in got.collect()] == [1, 3]


def test_doc_search_highlight(spark):
    docs = spark.createDataFrame(
        [(1, "Red fox, red.", "en", 13), (2, "reddish", "en", 7), (3, "red", "de", 3)],
        "doc_id long, text string, lang string, n_chars long")
    got = search.doc_search(docs, "red", {"lang": "en"}).collect()
    assert [(r.doc_id, r.hits, r.highlight) for r in got] == \
        [(1, 2, "<em>Red</em> fox, <em>red</em>.")]


def test_scale_conf_grows_with_input():
    from clickflow.session import scale_conf
    small, big = scale_conf(1 << 30), scale_conf(100 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == 100_000
    mid = scale_conf(10 << 40)
    assert int(mid["spark.sql.shuffle.partitions"]) == 10 << 10
