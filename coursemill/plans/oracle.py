"""The same inputs and results as SQL on the benchmark tables, for checking."""

from __future__ import annotations

# Inputs, as common table expressions.

VIEWS = """
views AS (
  SELECT event_id AS arrival, CAST(user_id AS VARCHAR) AS mid, CAST(k % 5 AS VARCHAR) AS sc,
         CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS is_new,
         CASE WHEN event_type = 'view' THEN 'order' ELSE event_type END AS page_id,
         CASE WHEN event_type <> 'signup' THEN event_type END AS last_page_id,
         CAST(k AS VARCHAR) AS item, k, event_type,
         CAST(trunc(value) AS BIGINT) AS during_time, ts, CAST(ts AS DATE) AS d
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) e)"""

REPAIRED = """
first_days AS (
  SELECT arrival, mid, is_new, d,
         first_value(CASE WHEN is_new = '1' THEN d ELSE CAST(d - INTERVAL 1 DAY AS DATE) END)
           OVER (PARTITION BY mid ORDER BY arrival) AS first_day
  FROM views),
repaired AS (
  SELECT arrival, mid,
         CASE WHEN is_new = '1' AND d <> first_day THEN '0' ELSE is_new END AS is_new
  FROM first_days)"""


def flags(views: str) -> str:
    return f"""
previous AS (
  SELECT *, last_page_id IS NULL OR last_page_id = '' AS starts,
         lag(d) OVER (PARTITION BY mid ORDER BY arrival) AS previous_d,
         lag(last_page_id IS NULL OR last_page_id = '')
           OVER (PARTITION BY mid ORDER BY arrival) AS previous_starts
  FROM {views}),
flags AS (
  SELECT *, CAST(CASE WHEN previous_d IS DISTINCT FROM d THEN 1 ELSE 0 END AS BIGINT) AS uv_ct,
         CAST(CASE WHEN starts THEN 1 ELSE 0 END AS BIGINT) AS sv_ct,
         CAST(CASE WHEN starts THEN 1 WHEN previous_starts THEN -1 ELSE 0 END AS BIGINT) AS so_ct
  FROM previous)"""


def stamps(time: str, day: str = "%Y-%m-%d") -> str:
    start = f"time_bucket(INTERVAL 10 SECONDS, {time})"
    return f"""strftime({start}, '%Y-%m-%d %H:%M:%S') AS stt,
         strftime({start} + INTERVAL 10 SECONDS, '%Y-%m-%d %H:%M:%S') AS edt,
         strftime({start}, '{day}') AS cur_date"""


TRAFFIC = f"""
traffic AS (
  SELECT {stamps('ts')}, sc, is_new, r_name AS source_name,
         CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(sv_ct) AS BIGINT) AS sv_ct,
         CAST(sum(so_ct) AS BIGINT) AS so_ct, count(*) AS pv_ct,
         CAST(sum(during_time) AS BIGINT) AS dur_sum
  FROM flags JOIN region ON CAST(r_regionkey AS VARCHAR) = sc
  GROUP BY ALL)"""

MONEY = "CAST(CAST({} AS DECIMAL(16,2)) AS VARCHAR)"


def money(column: str) -> str:
    return MONEY.format(column)


SECOND = "'%Y-%m-%d %H:%M:%S'"
EPOCH = "CAST(CAST(epoch({}) AS BIGINT) AS VARCHAR)"
LINE_ID = "concat_ws('-', l_orderkey, l_linenumber)"

DETAILS_ALL = f"""
order_views AS (
  SELECT CAST(c_custkey AS VARCHAR) AS sid, CAST(c_nationkey % 5 AS VARCHAR) AS sc, -1 AS arrival
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
  UNION ALL
  SELECT CAST(user_id AS VARCHAR),
         CAST(CAST(json_extract(props, '$.k') AS BIGINT) % 5 AS VARCHAR), event_id
  FROM events WHERE event_type = 'view'),
last_views AS (
  SELECT sid, arg_max(sc, arrival) AS sc FROM order_views GROUP BY sid),
lines AS (
  SELECT {LINE_ID} AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS course_id,
         'course ' || l_partkey AS course_name, {money('l_extendedprice')} AS origin_amount,
         '0.00' AS coupon_reduce, {money('l_extendedprice')} AS final_amount,
         strftime(l_shipdate, '%Y-%m-%d') AS date_id,
         strftime(l_shipdate, {SECOND}) AS create_time,
         CAST(o_custkey AS VARCHAR) AS session_id, CAST(o_custkey % 25 AS VARCHAR) AS province_id,
         {EPOCH.format('l_shipdate')} AS ts, l_shipdate AS t,
         l_orderkey AS a, l_linenumber AS b, l_partkey AS c, l_suppkey AS dd,
         CAST(epoch(l_shipdate) AS BIGINT) AS e,
         CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * 100 AS BIGINT) AS f
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_returnflag <> 'A' AND o_orderstatus <> 'P')"""

DETAIL_COLUMNS = ("id, order_id, user_id, course_id, course_name, origin_amount, coupon_reduce, "
                  "final_amount, date_id, create_time, session_id, province_id, source, ts")

DETAILS = DETAILS_ALL + """,
details AS (SELECT lines.*, sc AS source FROM lines JOIN last_views ON session_id = sid)"""

TRADE_FLAGS = DETAILS + """,
trade_flags AS (
  SELECT *, CAST(CASE WHEN lag(CAST(t AS DATE)) OVER (PARTITION BY user_id ORDER BY a, b, c, dd, e, f)
                      IS DISTINCT FROM CAST(t AS DATE) THEN 1 ELSE 0 END AS BIGINT)
              AS order_user_ct
  FROM details)"""

TRADE_SUMS = """count(*) AS order_ct, CAST(sum(order_user_ct) AS BIGINT) AS order_user_ct,
         CAST(sum(CAST(final_amount AS DECIMAL(16,2))) AS DOUBLE) AS order_amount"""

TRADE = TRADE_FLAGS + f""",
trade AS (
  SELECT {stamps('t')}, source AS sc, province_id, r_name AS source_name, n_name AS province_name,
         {TRADE_SUMS}
  FROM trade_flags JOIN region ON CAST(r_regionkey AS VARCHAR) = source
  JOIN nation ON CAST(n_nationkey AS VARCHAR) = province_id
  GROUP BY ALL)"""

PAYMENTS = f"""
paid AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderkey AS VARCHAR) AS order_id,
         {money('o_totalprice')} AS total_amount, o_orderdate AS pay_time
  FROM orders WHERE o_orderstatus = 'F')"""


def payment_success(before: str, after: str) -> str:
    return f"""WITH {DETAILS}, {PAYMENTS}
SELECT paid.id, paid.order_id, total_amount, ts, d.id AS detail_id, user_id, course_id,
       course_name, origin_amount, coupon_reduce, final_amount, session_id, province_id
FROM paid JOIN details d ON paid.order_id = d.order_id
 AND d.t BETWEEN pay_time - INTERVAL {before} AND pay_time + INTERVAL {after}"""


SPLIT = """
outputs AS (
  SELECT 'dwd_traffic_err_log' AS topic, arrival, CAST(NULL AS BIGINT) AS pos, true AS has_ts,
         true AS has_err, event_type = 'purchase' AS has_video, event_type = 'view' AS has_start
  FROM views WHERE event_type = 'error'
  UNION ALL
  SELECT 'dwd_traffic_app_video_log', arrival, NULL, true, false, true, false
  FROM views WHERE event_type = 'purchase'
  UNION ALL
  SELECT 'dwd_traffic_start_log', arrival, NULL, true, false, false, true
  FROM views WHERE event_type = 'view'
  UNION ALL
  SELECT 'dwd_traffic_page_log', arrival, NULL, true, false, false, false
  FROM views WHERE event_type NOT IN ('purchase', 'view')
  UNION ALL
  SELECT 'dwd_traffic_display_log', arrival, pos, true, false, false, false
  FROM views JOIN (SELECT unnest([1, 2]) AS pos) p ON pos <= k % 3
  WHERE event_type NOT IN ('purchase', 'view')
  UNION ALL
  SELECT 'dwd_traffic_action_log', arrival, pos, false, false, false, false
  FROM views JOIN (SELECT unnest([1, 2, 3]) AS pos) p ON pos <= k % 4
  WHERE event_type NOT IN ('purchase', 'view'))"""


def top(columns: str, source: str, name: str, measure: str, k: int = 10, where: str = "") -> str:
    return (f"SELECT {columns} FROM {source} {where} GROUP BY {name} "
            f"ORDER BY {measure} DESC NULLS LAST, {name} LIMIT {k}")
