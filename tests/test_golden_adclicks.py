"""Goldens for the ad-click jobs on the 143-row sample click log (FIXTURES.md §3).

The sample is not part of this repository: point ``CLICKFLOW_AD_SAMPLE`` at
the CSV to run the tests on it. ``test_hand_made_sample`` has rows of the same
shape (one user over the cap, others below) and always runs.
"""

import os

import pytest
from pyspark.sql import functions as F

from clickflow.functions.hashing import poly_hash
from clickflow.operators import ads
from clickflow.sources import scans

SAMPLE = os.environ.get("CLICKFLOW_AD_SAMPLE", "")


@pytest.fixture(scope="module")
def clicks(spark):
    if not (SAMPLE and os.path.exists(SAMPLE)):
        pytest.skip("CLICKFLOW_AD_SAMPLE not set")
    lines = spark.read.text(SAMPLE)
    parsed = scans.good(scans.parse_ad_click_lines(lines))
    # plain files carry no arrival number: use the line order
    return parsed.withColumn("seq", F.coalesce("seq", F.monotonically_increasing_id()))


def test_sample_shape(clicks):
    assert clicks.count() == 143
    assert clicks.select("province").distinct().count() == 7


def test_cap_pass_drop_warn(clicks):
    out = ads.ad_click_outcomes(clicks, cap=100)
    by = {r.outcome: r["count"] for r in out.groupBy("outcome").count().collect()}
    assert by.get("pass", 0) == 122
    assert by.get("warn", 0) + by.get("drop", 0) == 21
    warns = ads.ad_click_warnings(clicks, cap=100).collect()
    assert [(w.user_id, w.ad_id, w.warning, w.ts_sec) for w in warns] == \
        [(937166, 1715, "click over100次", 1511661701)]


def test_passed_by_province(clicks):
    passed = ads.ad_click_cap(clicks, cap=100)
    got = {r.province: r["count"] for r in passed.groupBy("province").count().collect()}
    assert got == {"beijing": 102, "guangdong": 5, "hebei": 1, "henan": 3,
                   "jiangsu": 4, "shanghai": 2, "zhejiang": 5}


def test_province_windows(clicks):
    w = ads.ad_clicks_by_province(ads.ad_click_cap(clicks, cap=100))
    assert w.count() == 99
    assert w.agg(F.sum("count")).first()[0] == 1464
    beijing = [(r.window_end // 1000, r["count"]) for r in
               w.where("province = 'beijing'").orderBy("window_end").collect()]
    assert beijing == ([(e, 2) for e in range(1511658300, 1511661600 + 1, 300)] +
                       [(e, 100) for e in range(1511661900, 1511665200 + 1, 300)])


def test_poly_hash_golden(spark):
    v = spark.range(1).select(poly_hash(F.lit("937166")).alias("h")).first().h
    assert v == 5543688


def test_hand_made_sample(spark):
    """100 clicks of one user on one ad pass, the 101st warns, the rest drops;
    another ad, another user and the next UTC day start anew."""
    day = 1_511_654_400
    lines = [f"937166,1715,beijing,beijing,{day + i}" for i in range(120)]
    lines += [f"937166,20,beijing,beijing,{day + i}" for i in range(3)]
    lines += [f"5,1715,hebei,x,{day + 7}", f"937166,1715,beijing,beijing,{day + 86_400}", "bad,row"]
    df = spark.createDataFrame(list(enumerate(lines)), "n long, value string")
    parsed = scans.good(scans.parse_ad_click_lines(df.orderBy("n").select("value").coalesce(1)))
    clicks = parsed.withColumn("seq", F.coalesce("seq", F.monotonically_increasing_id()))
    out = ads.ad_click_outcomes(clicks, cap=100)
    assert {r.outcome: r["count"] for r in out.groupBy("outcome").count().collect()} == \
        {"pass": 105, "warn": 1, "drop": 19}
    warns = ads.ad_click_warnings(clicks, cap=100).collect()
    assert [(w.user_id, w.ad_id, w.warning, w.ts_sec) for w in warns] == \
        [(937166, 1715, "click over100次", day + 100)]
    passed = ads.ad_click_cap(clicks, cap=100)
    assert passed.count() == 105
    w = ads.ad_clicks_by_province(passed)
    assert {r.province: r["sum(count)"] for r in w.groupBy("province").sum("count").collect()} == \
        {"beijing": 104 * 12, "hebei": 12}
