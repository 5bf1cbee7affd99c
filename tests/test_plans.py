"""Physical-plan checks: the shapes the operators are designed to produce."""

import os
import re

import pytest

import __spark_entry__ as E
from clickflow.operators import dau
from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_top_k_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in plan(E.queries()["hot_items"](spark, SF_SMALL))


def test_province_join_is_broadcast_by_size_only(spark):
    def made():
        return plan(E.queries()["order_with_province"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in made()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in made()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_scan_prunes_columns(spark):
    p = plan(E.queries()["pv_hourly"](spark, SF_SMALL))
    read = [ln for ln in p.splitlines() if "ReadSchema" in ln or "FileScan" in ln]
    assert read and all("value" not in ln for ln in read)


def test_dau_total_prunes_day_partitions(spark, scratch):
    docs = dau.dau_docs(dau.dau_first(E.queries()["log_route"](spark, SF_SMALL)
                                      .select("seq", "value")))
    out = os.path.join(scratch, "docs")
    docs.write.partitionBy("dt").parquet(out)
    q = dau.dau_total(spark.read.parquet(out), dt="2024-01-02")
    p = plan(q)
    assert "PartitionFilters: [isnotnull(dt" in p and "2024-01-02" in p
    assert q.count() == 1


def test_marketing_has_no_720_way_expand(spark):
    p = plan(E.queries()["marketing_by_channel"](spark, SF_SMALL))
    assert "Expand" not in p


def test_cap_drops_rows_before_the_shuffle(spark):
    """Each map task keeps the first rows per group and hash bucket only, and
    the input is read once."""
    for name in ["ad_click_cap", "ad_click_warnings", "ad_clicks_by_province"]:
        p = plan(E.queries()[name](spark, SF_SMALL))
        limits = [ln for ln in p.splitlines() if "WindowGroupLimit" in ln]
        assert any("Partial" in ln and "_bucket" in ln for ln in limits), name
        assert p.count("events.parquet") == 1, name


@pytest.mark.parametrize("name,parses", [
    ("cdc_split_array", 1), ("cdc_split_object", 1), ("order_decode", 2), ("order_time_parts", 2),
    ("order_first_flag", 2), ("order_with_province", 2), ("order_with_user", 2), ("dau_first", 1),
    ("dau_day_compare", 1), ("dedup_metrics", 1), ("dau_docs", 1)])
def test_json_is_parsed_once_per_record(spark, name, parses):
    """One parse per record (orders: one of the envelope, one of the order)."""
    assert optimized(E.queries()[name](spark, SF_SMALL)).count("from_json(") == parses


def test_running_uv_minima_are_hash_aggregates(spark):
    assert "SortAggregate" not in plan(E.queries()["uv_running"](spark, SF_SMALL))


def test_no_shuffle_is_added_to_scans(spark):
    p = plan(E.queries()["behavior_scan"](spark, SF_SMALL))
    assert "Exchange" not in p


def test_first_per_day_is_an_aggregate_not_a_window(spark):
    p = plan(E.queries()["dau_first"](spark, SF_SMALL))
    assert "Window" not in p and "partial_min" in p


def test_aggregations_combine_map_side(spark):
    for name in ["item_window_counts", "pv_hourly", "uv_hourly", "marketing_by_channel"]:
        p = plan(E.queries()[name](spark, SF_SMALL))
        assert "partial_" in p, name


@pytest.mark.parametrize("name,fields", [
    ("order_time_parts", {"id", "user_id", "create_time"}), ("order_first_flag", {"id", "user_id"}),
    ("order_first_flag_batch", {"id", "user_id", "create_time"}), ("order_with_user", {"id", "user_id"}),
    ("order_with_province", {"id", "province_id"}), ("user_state_update", {"id", "user_id"})])
def test_orders_parse_the_used_fields_only(spark, name, fields):
    p = optimized(E.queries()[name](spark, SF_SMALL))
    parsed = [set(re.findall(r"StructField\((\w+),", ln)) for ln in p.splitlines() if "from_json(" in ln]
    orders = [x - {"_corrupt"} for x in parsed if "table" not in x]
    assert orders and all(x == fields for x in orders)
