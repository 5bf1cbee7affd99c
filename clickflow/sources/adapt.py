"""Derive the reference's input tables from the generated test tables.

Every function here is a plain projection/join of ``events``, ``orders``,
``customer``, ``nation`` and ``region`` so the derived inputs grow with the
data. The equivalent SQL for each lives in ``clickflow.plans.oracle``.
The rules follow FIXTURES.md §2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.functions.time import ntz_epoch_seconds, utc_text

# Channel names (picked by user_id % 3, in this order).
CHANNELS = ["app store", "wechat", "weibo"]

# CDC table names.
CDC_ORDER_TABLE = "order_info"
CDC_USER_TABLE = "user_info"
CDC_GROUP = 3           # rows per array envelope
CDC_NULL_EVERY = 10     # every 10th group also gets a data-less envelope


def _pick(index: Column, values: list[str]) -> Column:
    out = F.lit(None).cast("string")
    for i in range(len(values) - 1, -1, -1):
        out = F.when(index == i, F.lit(values[i])).otherwise(out)
    return out


def event_base(events: DataFrame) -> DataFrame:
    """event_id, user_id, event_type, k, ts_sec (UTC, floored to seconds)."""
    ts_type = dict(events.dtypes)["ts"]
    ts_sec = (ntz_epoch_seconds("ts") if ts_type == "timestamp_ntz"
              else F.unix_seconds(F.col("ts")))
    return events.select(
        "event_id", "user_id", "event_type",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        ts_sec.alias("ts_sec"))


def behaviors(events: DataFrame) -> DataFrame:
    """User behaviour rows: user_id, item_id, category_id, behavior, ts_sec, seq."""
    e = event_base(events)
    t = F.col("event_type")
    behavior = (F.when(t == "view", F.when(F.col("event_id") % 7 == 0, F.lit("PV"))
                       .otherwise(F.lit("pv")))
                .when(t == "purchase", F.lit("buy"))
                .when(t == "click", F.lit("cart"))
                .when(t == "signup", F.lit("fav"))
                .when(t == "error", F.lit("error")))
    return e.select(
        "user_id", F.col("k").alias("item_id"),
        (F.col("k") % 10).cast("int").alias("category_id"),
        behavior.alias("behavior"), "ts_sec", F.col("event_id").alias("seq"))


def behavior_lines(events: DataFrame) -> DataFrame:
    """The behaviour CSV as text lines (``value``)."""
    b = behaviors(events)
    return b.select(F.concat_ws(",", *[F.col(c).cast("string") for c in b.columns])
                    .alias("value"))


def access_log_lines(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Web-log text lines: ip user - dd/MM/yyyy:HH:mm:ss +0000 method url.
    ``keep`` adds event columns (e.g. event_id, ts_sec) next to the line."""
    e = event_base(events)
    uid = F.col("user_id")
    ip = F.concat(F.lit("10.0."), F.floor(uid / 256).cast("string"), F.lit("."),
                  (uid % 256).cast("string"))
    t = F.col("event_type")
    method = (F.when(t == "view", F.lit("GET")).when(t == "click", F.lit("get"))
              .otherwise(F.lit("POST")))
    url = F.concat(F.lit("/p/"), F.col("k").cast("string"))
    when = utc_text(F.timestamp_seconds("ts_sec"), "dd/MM/yyyy:HH:mm:ss")
    return e.select(F.concat_ws(" ", ip, uid.cast("string"), F.lit("-"), when,
                                F.lit("+0000"), method, url).alias("value"), *keep)


def ad_clicks(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Ad clicks: user_id, ad_id, province, city, ts_sec, seq.

    ``nation`` is the fixed 25-row dimension, so it is broadcast; the
    customer join is left to the planner (AQE broadcasts it while small and
    falls back to a sort-merge join with skew splitting when it is not).
    """
    e = event_base(events)
    cust = (customer.select("c_custkey", "c_nationkey", "c_mktsegment")
            .join(F.broadcast(nation.select("n_nationkey", "n_name")),
                  F.col("c_nationkey") == F.col("n_nationkey"), "left"))
    j = e.join(cust, e.user_id == cust.c_custkey, "left")
    return j.select(
        "user_id", (F.col("k") % 3).alias("ad_id"),
        F.col("n_name").alias("province"), F.col("c_mktsegment").alias("city"),
        "ts_sec", F.col("event_id").alias("seq"))


def ad_click_lines(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    a = ad_clicks(events, customer, nation)
    return a.select(F.concat_ws(",", *[F.col(c).cast("string") for c in a.columns])
                    .alias("value"))


def marketing(events: DataFrame) -> DataFrame:
    """Marketing events: user_id, behavior, channel, ts_ms, seq."""
    e = event_base(events)
    t = F.col("event_type")
    behavior = (F.when(t.isin("click", "purchase"), F.lit("CLICK"))
                .when(t == "view", F.lit("DOWNLOAD"))
                .when(t == "signup", F.lit("INSTALL"))
                .when(t == "error", F.lit("UNINSTALL")))
    return e.select("user_id", behavior.alias("behavior"),
                    _pick(F.col("user_id") % 3, CHANNELS).alias("channel"),
                    (F.col("ts_sec") * 1000).alias("ts_ms"),
                    F.col("event_id").alias("seq"))


def app_logs(events: DataFrame) -> DataFrame:
    """App log JSON lines with their arrival sequence: seq, value.

    ``start`` is an object for view and signup, JSON null for error and
    absent otherwise.
    """
    e = event_base(events)
    uid = F.col("user_id").cast("string")
    common = F.concat(
        F.lit('{"mid":"mid_'), uid, F.lit('","uid":"'), uid,
        F.lit('","ar":"'), (F.col("user_id") % 5).cast("string"),
        F.lit('","ch":"'), _pick(F.col("user_id") % 3, CHANNELS),
        F.lit('","vc":"v'), (F.col("k") % 4).cast("string"), F.lit('"}'))
    t = F.col("event_type")
    start = (F.when(t.isin("view", "signup"),
                    F.concat(F.lit(',"start":{"entry":"'), t, F.lit('"}')))
             .when(t == "error", F.lit(',"start":null'))
             .otherwise(F.lit("")))
    value = F.concat(F.lit('{"common":'), common, start, F.lit(',"ts":'),
                     (F.col("ts_sec") * 1000).cast("string"), F.lit("}"))
    return e.select(F.col("event_id").alias("seq"), value.alias("value"))


def _money(c: str) -> Column:
    """A double as canonical JSON number text (shortest round-trip form),
    which JSON parsers re-serialise unchanged."""
    return F.col(c).cast("string")


def order_rows(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Order records as flat columns (before JSON encoding)."""
    cust = customer.select("c_custkey", "c_nationkey")
    j = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
    create = F.date_format(
        F.col("o_orderdate") + F.make_dt_interval(
            F.lit(0), (F.col("o_orderkey") % 24).cast("int")),
        "yyyy-MM-dd HH:mm:ss")
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").cast("long").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("final_total_amount"),
        create.alias("create_time"))


def order_json(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One order JSON object per row: id, value."""
    o = order_rows(orders, customer)
    value = F.concat(
        F.lit('{"id":'), F.col("id").cast("string"),
        F.lit(',"province_id":'), F.coalesce(F.col("province_id").cast("string"), F.lit("null")),
        F.lit(',"order_status":"'), F.col("order_status"),
        F.lit('","user_id":'), F.col("user_id").cast("string"),
        F.lit(',"final_total_amount":'), _money("final_total_amount"),
        F.lit(',"create_time":"'), F.col("create_time"), F.lit('"}'))
    return o.select("id", value.alias("value"))


def user_json(customer: DataFrame) -> DataFrame:
    """One user JSON object per customer: id, value."""
    value = F.concat(
        F.lit('{"id":'), F.col("c_custkey").cast("string"),
        F.lit(',"name":"'), F.col("c_name"),
        F.lit('","province_id":'), F.col("c_nationkey").cast("string"),
        F.lit(',"account_balance":'), _money("c_acctbal"),
        F.lit(',"segment":"'), F.col("c_mktsegment"), F.lit('"}'))
    return customer.select(F.col("c_custkey").alias("id"), value.alias("value"))


def _array_envelopes(rows: DataFrame, table: str) -> DataFrame:
    grouped = (rows.groupBy(F.floor(F.col("id") / CDC_GROUP).alias("g"))
               .agg(F.array_sort(F.collect_list(F.struct("id", "value"))).alias("rs")))
    data = F.concat_ws(",", F.transform("rs", lambda r: r["value"]))
    full = grouped.select(
        F.col("g"), F.concat(F.lit('{"table":"' + table + '","type":"INSERT","data":['),
                             data, F.lit("]}")).alias("value"))
    nulls = grouped.where(F.col("g") % CDC_NULL_EVERY == 0).select(
        F.col("g"), F.lit('{"table":"' + table + '","type":"ALTER","data":null}')
        .alias("value"))
    return full.unionByName(nulls)


def cdc_array_envelopes(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Array-form CDC envelopes for orders and users: value."""
    env = _array_envelopes(order_json(orders, customer), CDC_ORDER_TABLE).unionByName(
        _array_envelopes(user_json(customer), CDC_USER_TABLE))
    return env.select("value")


def cdc_object_envelopes(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Object-form CDC envelopes, one per order or user: value."""
    def wrap(rows: DataFrame, table: str) -> DataFrame:
        return rows.select(F.concat(
            F.lit('{"database":"shop","table":"' + table + '","type":"insert","data":'),
            F.col("value"), F.lit("}")).alias("value"))
    return wrap(order_json(orders, customer), CDC_ORDER_TABLE).unionByName(
        wrap(user_json(customer), CDC_USER_TABLE))


def cdc_change_envelopes(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Object-form envelopes with operations, one per change of an order: an
    insert each, an update of the status for ids divisible by 3 or 5, a delete
    for ids divisible by 7, and the insert once more for ids divisible by 11.
    An update may carry a later ``ts`` than the delete, or the insert's."""
    o = order_json(orders, customer)
    k = F.col("id")
    ts = F.lit(1_700_000_000) + k % 1000
    updated = F.regexp_replace("value", '"order_status":"[^"]*"', '"order_status":"U"')

    def change(kind: str, at: Column, n: int, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), at.cast("long").alias("ts"),
                        (k * 4 + n).alias("xid"), value.alias("data"))

    insert = change("insert", ts, 0, F.col("value"))
    c = F.array(insert,
                F.when((k % 3 == 0) | (k % 5 == 0), change("update", ts + k % 4, 1, updated)),
                F.when(k % 7 == 0, change("delete", ts + 2, 2, F.col("value"))),
                F.when(k % 11 == 0, insert))
    each = o.select(F.explode(F.filter(c, lambda x: x.isNotNull())).alias("c"))
    return each.select(F.concat(
        F.lit('{"database":"shop","table":"' + CDC_ORDER_TABLE + '","type":"'), F.col("c.type"),
        F.lit('","ts":'), F.col("c.ts").cast("string"), F.lit(',"xid":'), F.col("c.xid").cast("string"),
        F.lit(',"data":'), F.col("c.data"), F.lit("}")).alias("value"))


def user_state(customer: DataFrame) -> DataFrame:
    """user_id, if_consumed: custkey % 3 = 0 -> '1', 1 -> '0', 2 -> no row."""
    m = F.col("c_custkey") % 3
    return (customer.where(m != 2)
            .select(F.col("c_custkey").alias("user_id"),
                    F.when(m == 0, F.lit("1")).otherwise(F.lit("0")).alias("if_consumed")))


def province_dim(nation: DataFrame, region: DataFrame) -> DataFrame:
    """id, name, area_code, iso_code (25 rows; nation x region)."""
    j = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left")
    return j.select(F.col("n_nationkey").cast("long").alias("id"),
                    F.col("n_name").alias("name"),
                    F.col("r_regionkey").cast("string").alias("area_code"),
                    F.substring("n_name", 1, 2).alias("iso_code"))


# Age-group bands over c_acctbal (upper bounds, exclusive).
AGE_BANDS = [(0.0, "under 20"), (3000.0, "20-30"), (6000.0, "30-40")]
AGE_TOP = "40+"


def user_dim(customer: DataFrame) -> DataFrame:
    """id, age_group, gender."""
    bal = F.col("c_acctbal")
    age = F.lit(AGE_TOP)
    for bound, label in reversed(AGE_BANDS):
        age = F.when(bal < bound, F.lit(label)).otherwise(age)
    gender = F.when(F.col("c_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M"))
    return customer.select(F.col("c_custkey").alias("id"), age.alias("age_group"),
                           gender.alias("gender"))
