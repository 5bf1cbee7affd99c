"""DuckDB SQL that computes the expected result of each registered query.

The SQL reads the same test tables (views ``events``, ``orders``,
``customer``, ``nation``, ``region``, ``documents``) and re-derives the
reference inputs with the FIXTURES.md rules, written independently of the
Spark code: windows are pane arithmetic plus ``range(n)``, rankings are plain
``row_number()`` over whole groups (the brute-force form).
"""

from __future__ import annotations

HOUR = 3_600_000
MIN5 = 300_000

# ---- derived inputs --------------------------------------------------------

EVENT_BASE = """
SELECT event_id, user_id, event_type,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ts_sec
FROM events"""

BEHAVIORS = f"""
SELECT user_id, k AS item_id, CAST(k % 10 AS INTEGER) AS category_id,
       CASE event_type
         WHEN 'view' THEN CASE WHEN event_id % 7 = 0 THEN 'PV' ELSE 'pv' END
         WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'cart'
         WHEN 'signup' THEN 'fav' WHEN 'error' THEN 'error' END AS behavior,
       ts_sec, event_id AS seq
FROM ({EVENT_BASE})"""

ACCESS_LOGS = f"""
SELECT '10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS ip,
       CAST(user_id AS VARCHAR) AS "user", ts_sec * 1000 AS ts_ms,
       CASE event_type WHEN 'view' THEN 'GET' WHEN 'click' THEN 'get' ELSE 'POST' END AS method,
       '/p/' || CAST(k AS VARCHAR) AS url
FROM ({EVENT_BASE})"""

AD_CLICKS = f"""
SELECT e.user_id, e.k % 3 AS ad_id, n.n_name AS province, c.c_mktsegment AS city,
       e.ts_sec, e.event_id AS seq
FROM ({EVENT_BASE}) e
LEFT JOIN customer c ON e.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""

MARKETING = f"""
SELECT user_id,
       CASE WHEN event_type IN ('click', 'purchase') THEN 'CLICK'
            WHEN event_type = 'view' THEN 'DOWNLOAD'
            WHEN event_type = 'signup' THEN 'INSTALL'
            WHEN event_type = 'error' THEN 'UNINSTALL' END AS behavior,
       CASE user_id % 3 WHEN 0 THEN 'app store' WHEN 1 THEN 'wechat' ELSE 'weibo' END AS channel,
       ts_sec * 1000 AS ts_ms, event_id AS seq
FROM ({EVENT_BASE})"""


def windows(rows: str, keys: str, size: int, slide: int) -> str:
    """Explode each row (with ts_ms) into the window ends containing it."""
    n = size // slide
    return f"""
SELECT {keys}, (ts_ms // {slide} + 1 + i) * {slide} AS window_end
FROM ({rows}) r CROSS JOIN range({n}) t(i)"""


def sql_hash(expr: str, mask: int) -> str:
    return (f"list_reduce(list_concat([0::BIGINT], list_transform(str_split({expr}, ''), "
            f"lambda c: ascii(c)::BIGINT)), lambda a, c: (a * 61 + c) & {mask})")


PV_ANY = f"SELECT *, ts_sec * 1000 AS ts_ms FROM ({BEHAVIORS}) WHERE lower(behavior) = 'pv'"
PV_EXACT = f"SELECT *, ts_sec * 1000 AS ts_ms FROM ({BEHAVIORS}) WHERE behavior = 'pv'"
GETS = f"SELECT * FROM ({ACCESS_LOGS}) WHERE lower(method) = 'get'"

ITEM_COUNTS = f"""
SELECT item_id, window_end, count(*) AS count
FROM ({windows(PV_ANY, 'item_id', HOUR, MIN5)}) GROUP BY item_id, window_end"""

HOT_ITEMS = f"""
SELECT window_end, rank, item_id, count FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY count DESC, item_id) AS INTEGER) AS rank
  FROM ({ITEM_COUNTS})) WHERE rank <= 5"""

PAGE_COUNTS = f"""
SELECT url, window_end, count(*) AS count
FROM ({windows(GETS, 'url', 20 * 60_000, MIN5)}) GROUP BY url, window_end"""

HOT_PAGES = f"""
SELECT window_end, rank, url, count FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY count DESC, url) AS INTEGER) AS rank
  FROM ({PAGE_COUNTS})) WHERE rank <= 3"""


def report(ranked: str, key: str, key_label: str, count_label: str, bottom: str) -> str:
    line = (f"'NO ' || CAST(rank AS VARCHAR) || ':' || '{key_label}' || CAST({key} AS VARCHAR)"
            f" || '{count_label}' || CAST(count AS VARCHAR)")
    return f"""
SELECT window_end,
       '======================' || chr(10) || '窗口结束时间：'
       || strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
       || string_agg({line}, chr(10) ORDER BY rank) || chr(10) || '{bottom}' || chr(10) || chr(10)
       AS report
FROM ({ranked}) GROUP BY window_end"""


HOUR_END = f"(ts_ms // {HOUR} + 1) * {HOUR}"

PV_HOURLY = f"""
SELECT 'pv' AS url, {HOUR_END} AS window_end, count(*) AS count
FROM ({PV_ANY}) GROUP BY 2"""

UV_HOURLY = f"""
SELECT 'uv' AS url, {HOUR_END} AS window_end, count(DISTINCT user_id) AS count
FROM ({PV_EXACT}) GROUP BY 2"""


def uv_bitmap(mask: int) -> str:
    return f"""
SELECT 'uv' AS url, {HOUR_END} AS window_end,
       count(DISTINCT {sql_hash('CAST(user_id AS VARCHAR)', mask)}) AS count
FROM ({PV_EXACT}) GROUP BY 2"""


def uv_bitmap_rollup(mask: int) -> str:
    seen = f"""
SELECT {HOUR_END} - {HOUR} AS h, {sql_hash('CAST(user_id AS VARCHAR)', mask)} AS bit
FROM ({PV_EXACT})"""
    return f"""
WITH seen AS ({seen})
SELECT 'hour' AS grain, h AS period, count(DISTINCT bit) AS count FROM seen GROUP BY h
UNION ALL
SELECT 'day', h - h % 86400000, count(DISTINCT bit) FROM seen GROUP BY 2
UNION ALL
SELECT 'all', CAST(0 AS BIGINT), count(DISTINCT bit) FROM seen HAVING count(*) > 0"""


def uv_running(mask: int) -> str:
    return f"""
WITH pv AS (
  SELECT user_id, ts_sec, seq, {HOUR_END} AS window_end,
         {sql_hash('CAST(user_id AS VARCHAR)', mask)} AS "offset"
  FROM ({PV_EXACT})),
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_end, "offset" ORDER BY ts_sec, seq) AS rn
                 FROM pv) WHERE rn = 1)
SELECT 'uv' AS url, window_end,
       row_number() OVER (PARTITION BY window_end ORDER BY ts_sec, seq) AS count,
       user_id, ts_sec
FROM firsts"""


POLY_HASH = f"""
SELECT user_id, {sql_hash('CAST(user_id AS VARCHAR)', (1 << 29) - 1)} AS "offset"
FROM (SELECT DISTINCT user_id FROM ({BEHAVIORS}))"""

BEHAVIOR_SCAN = BEHAVIORS
ACCESS_LOG_SCAN = ACCESS_LOGS


def behavior_sql() -> dict[str, str]:
    full, small = (1 << 29) - 1, (1 << 6) - 1
    return {
        "behavior_scan": BEHAVIOR_SCAN,
        "access_log_scan": ACCESS_LOG_SCAN,
        "item_window_counts": ITEM_COUNTS,
        "hot_items": HOT_ITEMS,
        "hot_items_report": report(HOT_ITEMS, "item_id", " 商品ID = ", " 热门度 = ",
                                   "==================="),
        "page_window_counts": PAGE_COUNTS,
        "hot_pages": HOT_PAGES,
        "hot_pages_report": report(HOT_PAGES, "url", " = ", " 浏览量 = ",
                                   "=============================="),
        "pv_hourly": PV_HOURLY,
        "pv_hourly_salted": PV_HOURLY,
        "uv_hourly": UV_HOURLY,
        "poly_hash": POLY_HASH,
        "uv_hourly_bitmap": uv_bitmap(full),
        "uv_hourly_bitmap_small_mask": uv_bitmap(small),
        "uv_bitmap_rollup": uv_bitmap_rollup(full),
        "uv_running": uv_running(full),
        "uv_running_small_mask": uv_running(small),
    }




# ---- ads and marketing -----------------------------------------------------

def ad_ranked(cap_groups: str = "user_id, ad_id, ts_sec // 86400") -> str:
    return f"""
SELECT *, row_number() OVER (PARTITION BY {cap_groups} ORDER BY ts_sec, seq) AS click_no
FROM ({AD_CLICKS})"""


def ad_sql(cap: int) -> dict[str, str]:
    passed = f"SELECT user_id, ad_id, province, city, ts_sec, seq FROM ({ad_ranked()}) WHERE click_no <= {cap}"
    warns = (f"SELECT user_id, ad_id, 'click over{cap}次' AS warning, ts_sec "
             f"FROM ({ad_ranked()}) WHERE click_no = {cap + 1}")
    by_province = f"""
SELECT province, window_end, count(*) AS count
FROM ({windows(f"SELECT *, ts_sec * 1000 AS ts_ms FROM ({passed})", 'province', HOUR, MIN5)})
GROUP BY province, window_end"""
    marketing = f"""
SELECT channel, behavior, window_end, count(*) AS count
FROM ({windows(f"SELECT * FROM ({MARKETING}) WHERE behavior IS DISTINCT FROM 'UNINSTALL'",
               'channel, behavior', HOUR, 5000)})
GROUP BY channel, behavior, window_end"""
    return {
        "ad_click_scan": AD_CLICKS,
        "ad_click_cap": passed,
        "ad_click_warnings": warns,
        "ad_clicks_by_province": by_province,
        "marketing_by_channel": marketing,
    }


# ---- app logs, DAU, dashboard ------------------------------------------------

APP_LOGS = f"""
SELECT event_id AS seq,
       '{{"common":{{"mid":"mid_' || CAST(user_id AS VARCHAR) || '","uid":"' || CAST(user_id AS VARCHAR)
       || '","ar":"' || CAST(user_id % 5 AS VARCHAR) || '","ch":"'
       || CASE user_id % 3 WHEN 0 THEN 'app store' WHEN 1 THEN 'wechat' ELSE 'weibo' END
       || '","vc":"v' || CAST(k % 4 AS VARCHAR) || '"}}'
       || CASE WHEN event_type IN ('view', 'signup') THEN ',"start":{{"entry":"' || event_type || '"}}'
               WHEN event_type = 'error' THEN ',"start":null' ELSE '' END
       || ',"ts":' || CAST(ts_sec * 1000 AS VARCHAR) || '}}' AS value
FROM ({EVENT_BASE})"""

ROUTED = f"""
SELECT seq, CASE WHEN json_extract_string(value, '$.start') IS NOT NULL
                 THEN 'GMALL_START' ELSE 'GMALL_EVENT' END AS topic, value
FROM ({APP_LOGS})"""

DECODED_STARTS = f"""
SELECT seq, json_extract_string(value, '$.common.mid') AS mid,
       json_extract_string(value, '$.common.uid') AS uid,
       json_extract_string(value, '$.common.ar') AS ar,
       json_extract_string(value, '$.common.ch') AS ch,
       json_extract_string(value, '$.common.vc') AS vc,
       CAST(json_extract_string(value, '$.ts') AS BIGINT) AS ts,
       strftime(make_timestamp(CAST(json_extract_string(value, '$.ts') AS BIGINT) * 1000), '%Y-%m-%d') AS dt
FROM ({ROUTED}) WHERE topic = 'GMALL_START'"""

DAU_FIRST = f"""
SELECT dt, mid, uid, ar, ch, vc, ts, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY dt, mid ORDER BY ts, seq) AS rn FROM ({DECODED_STARTS}))
WHERE rn = 1"""

DAU_DOCS = f"""
SELECT dt || '_' || mid AS id, mid, uid, ar, ch, vc, dt,
       strftime(make_timestamp(ts * 1000), '%H') AS hr,
       strftime(make_timestamp(ts * 1000), '%M') AS mi, ts
FROM ({DAU_FIRST})"""

DAU_BY_HOUR = f"SELECT dt, hr, count(*) AS count FROM ({DAU_DOCS}) GROUP BY dt, hr"


def dau_sql() -> dict[str, str]:
    return {
        "log_route": ROUTED,
        "raw_log_archive": f"""
SELECT strftime(make_timestamp(CAST(json_extract_string(value, '$.ts') AS BIGINT) * 1000), '%Y-%m-%d') AS dt,
       value FROM ({APP_LOGS})""",
        "dau_first": DAU_FIRST,
        "dau_docs": DAU_DOCS,
        "dau_total": f"""
SELECT dt, 'dau' AS id, '新增日活' AS name, count(*) AS value FROM ({DAU_DOCS}) GROUP BY dt""",
        "dau_by_minute_top24": f"""
SELECT dt, mi, count, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY dt ORDER BY count DESC, mi) AS INTEGER) AS rank
  FROM (SELECT dt, mi, count(*) AS count FROM ({DAU_DOCS}) GROUP BY dt, mi)) WHERE rank <= 24""",
        "dau_by_hour": DAU_BY_HOUR,
        "dau_day_compare": f"""
SELECT dt, 'today' AS day, hr, count FROM ({DAU_BY_HOUR})
UNION ALL
SELECT strftime(CAST(dt AS DATE) + 1, '%Y-%m-%d') AS dt, 'yesterday' AS day, hr, count
FROM ({DAU_BY_HOUR})""",
        "dedup_metrics": f"""
SELECT dt, count(*) AS rows_before, count(DISTINCT mid) AS rows_after
FROM ({DECODED_STARTS}) GROUP BY dt""",
    }


# ---- CDC and orders ------------------------------------------------------------

ORDER_ROWS = """
SELECT o.o_orderkey AS id, CAST(c.c_nationkey AS BIGINT) AS province_id,
       o.o_orderstatus AS order_status, o.o_custkey AS user_id,
       o.o_totalprice AS final_total_amount,
       CAST(o.o_totalprice AS VARCHAR) AS amount_text,
       strftime(o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS create_time
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""

ORDER_JSON = f"""
SELECT id, '{{"id":' || CAST(id AS VARCHAR) || ',"province_id":' || coalesce(CAST(province_id AS VARCHAR), 'null')
       || ',"order_status":"' || order_status || '","user_id":' || CAST(user_id AS VARCHAR)
       || ',"final_total_amount":' || amount_text || ',"create_time":"' || create_time || '"}}' AS value
FROM ({ORDER_ROWS})"""

USER_JSON = """
SELECT c_custkey AS id, '{"id":' || CAST(c_custkey AS VARCHAR) || ',"name":"' || c_name
       || '","province_id":' || CAST(c_nationkey AS VARCHAR) || ',"account_balance":'
       || CAST(c_acctbal AS VARCHAR) || ',"segment":"' || c_mktsegment || '"}' AS value
FROM customer"""

CDC_ROWS = f"""
SELECT 'ODS_ORDER_INFO' AS topic, value FROM ({ORDER_JSON})
UNION ALL
SELECT 'ODS_USER_INFO' AS topic, value FROM ({USER_JSON})"""

ORDERS_DECODED = f"""
SELECT id, province_id, order_status, user_id, final_total_amount,
       CAST(NULL AS DOUBLE) AS benefit_reduce_amount, CAST(NULL AS DOUBLE) AS original_total_amount,
       CAST(NULL AS DOUBLE) AS feight_fee, CAST(NULL AS VARCHAR) AS expire_time, create_time,
       CAST(NULL AS VARCHAR) AS operate_time
FROM ({ORDER_ROWS})"""

# Every change as its own row, the last one per order by plain ranking.
CDC_LATEST = f"""
WITH o AS (SELECT id, value, 1700000000 + id % 1000 AS t FROM ({ORDER_JSON})),
change AS (
  SELECT id, 'insert' AS type, t AS ts, id * 4 AS seq, value FROM o
  UNION ALL
  SELECT id, 'update', t + id % 4, id * 4 + 1,
         regexp_replace(value, '"order_status":"[^"]*"', '"order_status":"U"')
  FROM o WHERE id % 3 = 0 OR id % 5 = 0
  UNION ALL
  SELECT id, 'delete', t + 2, id * 4 + 2, value FROM o WHERE id % 7 = 0)
SELECT 'order_info' AS "table", CAST(id AS VARCHAR) AS key, CAST(ts AS BIGINT) AS ts,
       CAST(seq AS BIGINT) AS seq, value
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) AS rn FROM change)
WHERE rn = 1 AND type <> 'delete'"""

USER_STATE = """
SELECT c_custkey AS user_id, CASE WHEN c_custkey % 3 = 0 THEN '1' ELSE '0' END AS if_consumed
FROM customer WHERE c_custkey % 3 <> 2"""

PROVINCES = """
SELECT CAST(n.n_nationkey AS BIGINT) AS id, n.n_name AS name, CAST(r.r_regionkey AS VARCHAR) AS area_code,
       substr(n.n_name, 1, 2) AS iso_code
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""

USERS = """
SELECT c_custkey AS id,
       CASE WHEN c_acctbal < 0 THEN 'under 20' WHEN c_acctbal < 3000 THEN '20-30'
            WHEN c_acctbal < 6000 THEN '30-40' ELSE '40+' END AS age_group,
       CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender
FROM customer"""


def order_sql() -> dict[str, str]:
    return {
        "cdc_split_array": CDC_ROWS,
        "cdc_split_object": CDC_ROWS,
        "cdc_latest_rows": CDC_LATEST,
        "order_decode": ORDERS_DECODED,
        "order_time_parts": f"""
SELECT id, user_id, create_time, split_part(create_time, ' ', 1) AS create_date,
       split_part(split_part(create_time, ' ', 2), ':', 1) AS create_hour
FROM ({ORDERS_DECODED})""",
        "order_first_flag": f"""
SELECT o.id, o.user_id,
       CASE WHEN s.user_id IS NULL THEN '' WHEN lower(s.if_consumed) = '1' THEN '0' ELSE '1' END
       AS if_first_order
FROM ({ORDERS_DECODED}) o LEFT JOIN ({USER_STATE}) s ON o.user_id = s.user_id""",
        "order_first_flag_batch": f"""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) AS rn
           FROM ({ORDERS_DECODED}))
SELECT o.id, o.user_id,
       CASE WHEN o.rn = 1 AND coalesce(lower(s.if_consumed) = '1', false) = false THEN '1' ELSE '0' END
       AS if_first_order
FROM o LEFT JOIN ({USER_STATE}) s ON o.user_id = s.user_id""",
        "order_with_province": f"""
SELECT o.id, o.province_id, p.name AS province_name, p.area_code AS province_area_code,
       p.iso_code AS province_iso_code
FROM ({ORDERS_DECODED}) o LEFT JOIN ({PROVINCES}) p ON o.province_id = p.id""",
        "order_with_user": f"""
SELECT o.id, o.user_id, u.age_group AS user_age_group, u.gender AS user_gender
FROM ({ORDERS_DECODED}) o LEFT JOIN ({USERS}) u ON o.user_id = u.id""",
        "user_state_update": f"""
WITH b AS (SELECT DISTINCT user_id FROM ({ORDERS_DECODED}))
SELECT coalesce(b.user_id, s.user_id) AS user_id,
       CASE WHEN b.user_id IS NOT NULL THEN '1' ELSE s.if_consumed END AS if_consumed
FROM ({USER_STATE}) s FULL OUTER JOIN b ON s.user_id = b.user_id""",
        "sql_rows": f"""
SELECT if_consumed, count(*) AS users FROM ({USER_STATE}) GROUP BY if_consumed""",
    }


SEARCH_TOKEN = "that"
SEARCH_WORDS = ["that", "and"]


def search_sql() -> dict[str, str]:
    t = SEARCH_TOKEN
    toks = "list_filter(regexp_split_to_array(lower(text), '\\W+'), lambda x: x <> '')"
    page = f"""
SELECT doc_id, lang, n_chars,
       CAST(len(list_filter({toks}, lambda x: x = '{t}')) AS INTEGER) AS hits,
       regexp_replace(text, '(?i)\\b({t})\\b', '<em>\\1</em>', 'g') AS highlight
FROM documents WHERE list_contains({toks}, '{t}') AND lang = 'en'
ORDER BY n_chars DESC, doc_id LIMIT 20"""
    a, b = SEARCH_WORDS

    def part(tf: str) -> str:
        df = f"(SELECT count(*) FROM d WHERE {tf} > 0)"
        idf = f"ln(1 + ((SELECT count(*) FROM d) - {df} + 0.5) / ({df} + 0.5))"
        return f"{idf} * {tf} * 2.2 / ({tf} + 1.2 * (0.25 + 0.75 * n / (SELECT avg(n) FROM d)))"

    ranked = f"""
WITH d AS (
  SELECT doc_id, lang, len(t) AS n, len(list_filter(t, lambda x: x = '{a}')) AS fa,
         len(list_filter(t, lambda x: x = '{b}')) AS fb
  FROM (SELECT doc_id, lang, coalesce({toks}, []) AS t FROM documents))
SELECT doc_id, lang, CAST(fa + fb AS INTEGER) AS hits,
       round({part('fa')} + {part('fb')}, 6) AS score
FROM d WHERE fa > 0 AND fb > 0"""
    return {"doc_search": page, "doc_search_indexed": page, "doc_search_ranked": ranked}


AD_CAP = 2


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(behavior_sql())
    out.update(ad_sql(AD_CAP))
    out.update(dau_sql())
    out.update(order_sql())
    out.update(search_sql())
    return out
