"""Results do not depend on the session time zone (the driver's session may
not be UTC): window ends are epoch ms and all text is rendered in UTC."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL, rows

NAMES = ["hot_items_report", "dau_docs", "dau_day_compare", "access_log_scan",
         "order_time_parts", "raw_log_archive", "ad_click_warnings", "behavior_scan"]


@pytest.mark.parametrize("name", NAMES)
def test_same_result_in_other_zone(spark, name):
    q = E.queries()[name]
    utc = rows(q(spark, SF_SMALL))
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = rows(q(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other
