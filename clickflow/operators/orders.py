"""Order enrichment.

Orders are the typed record of ``clickflow.schemas.ORDER`` (see
``sources.scans.decode_orders``). Dimension joins are left joins so no order
is ever lost. All joins are left to the planner: AQE broadcasts a dimension
while it is small and otherwise runs a sort-merge join with skew splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIRST_ORDER = "1"
NOT_FIRST_ORDER = "0"
NO_STATE = ""


def order_time_parts(orders: DataFrame) -> DataFrame:
    """P8 (fixed): create_date and create_hour from ``create_time``
    ('yyyy-MM-dd HH:mm:ss')."""
    parts = F.split(F.col("create_time"), " ")
    date = F.try_element_at(parts, F.lit(1))
    hour = F.try_element_at(F.split(F.try_element_at(parts, F.lit(2)), ":"), F.lit(1))
    return orders.withColumn("create_date", date).withColumn("create_hour", hour)


def order_first_flag(orders: DataFrame, user_state: DataFrame,
                     within_batch: bool = False) -> DataFrame:
    """``if_first_order`` from the user's consumed state.

    State '1' (any case) -> '0'; any other state -> '1'; no state row -> ''.
    With ``within_batch`` (J5's intent) a missing state means "never
    consumed", and among one user's orders in the batch only the earliest
    by (create_time, id) can be the first order.
    """
    st = user_state.select(F.col("user_id").alias("_su"),
                           F.col("if_consumed").alias("_consumed"))
    consumed = F.lower(F.col("_consumed")) == "1"
    if not within_batch:
        j = orders.drop("if_first_order").join(st, F.col("user_id") == F.col("_su"), "left")
        flag = (F.when(F.col("_su").isNull(), F.lit(NO_STATE))
                .when(consumed, F.lit(NOT_FIRST_ORDER)).otherwise(F.lit(FIRST_ORDER)))
        return j.withColumn("if_first_order", flag).drop("_su", "_consumed")
    # one row per user: its earliest order, unless the state says consumed;
    # the orders themselves are joined once, to that
    earliest = (orders.groupBy(F.col("user_id").alias("_eu"))
                .agg(F.min(F.struct("create_time", "id"))["id"].alias("_first_id")))
    firsts = (earliest.join(st, F.col("_eu") == F.col("_su"), "left")
              .where(~F.coalesce(consumed, F.lit(False))).select("_eu", "_first_id"))
    j = orders.drop("if_first_order").join(firsts, F.col("user_id") == F.col("_eu"), "left")
    first = F.col("id") == F.col("_first_id")
    return (j.withColumn("if_first_order",
                         F.when(first, F.lit(FIRST_ORDER)).otherwise(F.lit(NOT_FIRST_ORDER)))
            .drop("_eu", "_first_id"))


def order_with_province(orders: DataFrame, provinces: DataFrame) -> DataFrame:
    """Province name, area code and iso code by ``province_id``."""
    p = provinces.select(F.col("id").alias("_pid"), F.col("name").alias("_pname"),
                         F.col("area_code").alias("_parea"),
                         F.col("iso_code").alias("_piso"))
    j = orders.join(p, F.col("province_id") == F.col("_pid"), "left")
    return (j.withColumn("province_name", F.col("_pname"))
            .withColumn("province_area_code", F.col("_parea"))
            .withColumn("province_iso_code", F.col("_piso"))
            .drop("_pid", "_pname", "_parea", "_piso"))


def order_with_user(orders: DataFrame, users: DataFrame) -> DataFrame:
    """User age group and gender by ``user_id``."""
    u = users.select(F.col("id").alias("_uid"), F.col("age_group").alias("_age"),
                     F.col("gender").alias("_gender"))
    j = orders.join(u, F.col("user_id") == F.col("_uid"), "left")
    return (j.withColumn("user_age_group", F.col("_age"))
            .withColumn("user_gender", F.col("_gender"))
            .drop("_uid", "_age", "_gender"))


def user_state_update(orders: DataFrame, user_state: DataFrame) -> DataFrame:
    """The state after a batch -- every user with an order is consumed
    ('1'); others keep their state. Output: user_id, if_consumed."""
    buyers = orders.select(F.col("user_id").alias("_bu")).distinct()
    j = user_state.join(buyers, F.col("user_id") == F.col("_bu"), "full_outer")
    return j.select(F.coalesce(F.col("_bu"), F.col("user_id")).alias("user_id"),
                    F.when(F.col("_bu").isNotNull(), F.lit("1"))
                    .otherwise(F.col("if_consumed")).alias("if_consumed"))
