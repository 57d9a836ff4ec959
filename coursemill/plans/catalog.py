"""Every registered query with its check in SQL.

Each query runs over whole tables. A limit stands only in top-k reports, a day only in the
reports of one day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from coursemill.functions import scalars
from coursemill.operators import asof, changelog, dims, facts, logsplit, reports, state, windows
from coursemill.operators.enrich import enrich, enrich_or_mark, without_dimension
from coursemill.operators.joins import interval_join
from coursemill.operators.upsert import latest_per_key
from coursemill.plans import jobs
from coursemill.plans import oracle as o
from coursemill.plans import standins as s
from coursemill.session import stored, use_result_conf, work_folder
from coursemill.sources.records import (
    change_log_records,
    config_records,
    order_detail_records,
    page_log_records,
)
from coursemill.sources.tables import report_day_partition
from coursemill.sources.topics import read_folder, to_messages
from coursemill.streaming import carried, sinks
from coursemill.streaming import jobs as streams

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Buckets of the tables that the streams of this size keep.
BUCKETS = 8

# Days of the one-day reports.
TRAFFIC_DAY = 20240115
TRADE_DAY = 20000404


def query(sql: str | None = None, name: str | None = None):
    def register(fn: Query) -> Query:
        key = name or fn.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(use_result_conf(spark), folder)

        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return register


def _amounts_as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


# --- change log -------------------------------------------------------------------------------

_CHANGES = f"""changes AS (
  SELECT t.name AS "table", CASE WHEN l_returnflag = 'A' THEN 'update' ELSE 'insert' END AS type,
         {o.EPOCH.format('l_shipdate')} AS ts, {o.LINE_ID} AS id
  FROM lineitem JOIN (SELECT unnest(['order_detail', 'test_exam_question', 'review_info']) AS name)
    t ON true
  UNION ALL
  SELECT t.name, CASE WHEN o_orderstatus = 'P' AND t.name <> 'payment_info' THEN 'update'
                      ELSE 'insert' END,
         {o.EPOCH.format('o_orderdate')}, CAST(o_orderkey AS VARCHAR)
  FROM orders JOIN (SELECT unnest(['order_info', 'payment_info', 'test_exam']) AS name) t ON true
  UNION ALL
  SELECT 'cart_info', CASE WHEN event_type = 'signup' THEN 'bootstrap-insert'
                           WHEN event_type <> 'error' THEN 'insert' END,
         CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR), CAST(event_id AS VARCHAR) FROM events
  UNION ALL
  SELECT 'user_info', CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'bootstrap-start'
           WHEN 'MACHINERY' THEN 'bootstrap-complete' WHEN 'FURNITURE' THEN 'bootstrap-insert'
           WHEN 'HOUSEHOLD' THEN 'update' ELSE 'insert' END,
         CAST(c_custkey AS VARCHAR), CAST(c_custkey AS VARCHAR) FROM customer)"""

_CHANGE_COUNTS = """SELECT "table", type, count(*) AS records, count(id) AS keyed,
       CAST(sum(CAST(ts AS BIGINT)) AS BIGINT) AS ts_sum FROM changes {} GROUP BY "table", type"""


def _change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("table", "type").agg(
        F.count("*").alias("records"), F.count(F.col("data")["id"]).alias("keyed"),
        F.sum(F.col("ts").try_cast("bigint")).alias("ts_sum"))


@query(f"WITH {_CHANGES} {_CHANGE_COUNTS.format('')}")
def change_log_from_json(spark, folder):
    return _change_counts(change_log_records(s.change_log_text(spark, folder)))


@query(f"""WITH {_CHANGES} {_CHANGE_COUNTS.format(
    "WHERE type IS NULL OR type NOT IN ('bootstrap-start', 'bootstrap-complete')")}""")
def change_log_without_load_markers(spark, folder):
    return _change_counts(changelog.without_load_markers(s.change_log(spark, folder)))


# --- other topics, from their JSON text -------------------------------------------------------

_ROW_TIME = f"strftime(date_trunc('second', ts), {o.SECOND}) AS row_time"


@query(f"""WITH {o.VIEWS}
SELECT arrival, mid, sc, is_new, page_id, last_page_id, item,
       CAST(during_time AS VARCHAR) AS during_time,
       CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS ts, {_ROW_TIME}
FROM views""")
def page_log_from_json(spark, folder):
    """The page log as maps, with event time cut to the second."""
    topic = s.page_log(spark, folder).select(
        F.to_json(F.struct("common", "page", "ts")).alias("value"), "arrival")
    common, page = F.col("common"), F.col("page")
    return page_log_records(topic).select(
        "arrival", *[common[n].alias(n) for n in ("mid", "sc", "is_new")],
        *[page[n].alias(n) for n in ("page_id", "last_page_id", "item", "during_time")], "ts",
        scalars.second_text(F.col("row_time")).alias("row_time"))


@query(f"""WITH {o.VIEWS} SELECT item AS keyword, count(*) AS keyword_count,
         {o.stamps("date_trunc('second', ts)", '%Y%m%d')}
FROM views WHERE event_type = 'click' GROUP BY ALL""")
def keyword_windows_from_json(spark, folder):
    """From page log text to the keyword windows."""
    topic = s.page_log(spark, folder).select(
        F.to_json(F.struct("common", "page", "ts")).alias("value"), "arrival")
    return windows.keyword_counts(windows.searches(page_log_records(topic)))


@query(f"""WITH {o.DETAILS} SELECT {o.DETAIL_COLUMNS},
       strftime(t, {o.SECOND}) AS row_time FROM details""")
def order_detail_from_json(spark, folder):
    """Order rows sent as JSON messages and read back, with their event time."""
    rows = _details(spark, folder)
    back = order_detail_records(to_messages(rows, "dwd_trade_order_detail", "arrival"))
    return back.withColumn("row_time", scalars.second_text(F.col("row_time")))


@query(f"""WITH {o.TRADE}
SELECT 'dws_trade_source_province_window' AS topic, stt, edt, cur_date, sc, province_id,
       source_name, province_name, order_ct, order_user_ct, order_amount, true AS without_ts
FROM trade""")
def trade_windows_as_messages(spark, folder):
    """Report rows as JSON lines, the time they were made from left out, parsed again."""
    rows = _trade(spark, folder).withColumn("ts", F.lit(1).cast("bigint"))
    lines = to_messages(rows, "dws_trade_source_province_window", "ts")
    parsed = lines.select("topic", F.from_json("value", rows.schema).alias("r"))
    back = parsed.select("topic", "r.*").withColumn("without_ts", F.col("ts").isNull()).drop("ts")
    return _amounts_as_double(back, "order_amount")


# --- facts ------------------------------------------------------------------------------------

def _fact(df: DataFrame) -> DataFrame:
    return df.drop("arrival", "row_time")


@query(f"""SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
       CAST(k AS VARCHAR) AS course_id, 'course ' || k AS course_name,
       {o.money('value')} AS cart_price, CAST(user_id AS VARCHAR) AS session_id,
       CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS ts
FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) e
WHERE event_type NOT IN ('signup', 'error')""")
def fact_cart_add(spark, folder):
    return _fact(facts.cart_add(s.change_log(spark, folder, "cart_info")))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name,
       c_mktsegment AS user_level, CAST(NULL AS VARCHAR) AS create_time,
       CAST(c_custkey AS VARCHAR) AS ts
FROM customer WHERE c_mktsegment = 'BUILDING'""")
def fact_user_register(spark, folder):
    return _fact(facts.user_register(s.change_log(spark, folder, "user_info")))


@query(f"""SELECT {o.LINE_ID} AS id, CAST(l_orderkey AS VARCHAR) AS exam_id,
       CAST(l_suppkey AS VARCHAR) AS paper_id, CAST(l_partkey AS VARCHAR) AS question_id,
       CAST(l_suppkey AS VARCHAR) AS user_id,
       CASE WHEN l_linestatus = 'O' THEN '1' ELSE '0' END AS is_correct
FROM lineitem WHERE l_returnflag <> 'A'""")
def fact_exam_question(spark, folder):
    return _fact(facts.exam_question(s.change_log(spark, folder, "test_exam_question")))


_EXAMS = f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS paper_id,
       CAST(o_custkey AS VARCHAR) AS user_id, {o.money('o_totalprice')} AS score,
       substr(o_orderpriority, 1, 1) AS duration_sec,
       strftime(o_orderdate, {o.SECOND}) AS create_time {{}}
FROM orders {{}} WHERE o_orderstatus <> 'P'"""


@query(_EXAMS.format(", CAST(c_nationkey AS VARCHAR) AS course_id",
                     "JOIN customer ON c_custkey = o_custkey"))
def fact_exam_paper(spark, folder):
    return _fact(facts.exam_paper(s.change_log(spark, folder, "test_exam"), s.test_paper(spark, folder)))


@query(f"""SELECT {o.LINE_ID} AS id, CAST(l_suppkey AS VARCHAR) AS user_id,
       CAST(l_partkey AS VARCHAR) AS course_id, p_name AS course_name,
       CAST(l_linenumber AS VARCHAR) AS review_stars, {o.EPOCH.format('l_shipdate')} AS ts
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag <> 'A'""")
def fact_review(spark, folder):
    return _fact(facts.review(s.change_log(spark, folder, "review_info"), s.course_info(spark, folder)))


@query(f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
       {o.money('o_totalprice')} AS origin_amount, '0.00' AS coupon_reduce,
       {o.money('o_totalprice')} AS final_amount, o_orderstatus AS order_status,
       CAST(o_custkey AS VARCHAR) AS session_id, CAST(o_custkey % 25 AS VARCHAR) AS province_id,
       {o.EPOCH.format('o_orderdate')} AS ts
FROM orders WHERE o_orderstatus <> 'P'""")
def order_headers(spark, folder):
    return _fact(changelog.order_headers(s.change_log(spark, folder, "order_info")))


@query(f"""WITH {o.PAYMENTS} SELECT id, order_id, total_amount,
       CAST(CAST(epoch(pay_time) AS BIGINT) AS VARCHAR) AS ts,
       strftime(pay_time, {o.SECOND}) AS pay_time FROM paid""")
def payments(spark, folder):
    paid = changelog.payments(changelog.with_row_time(
        s.change_log(spark, folder, "payment_info")))
    return paid.withColumn("pay_time", scalars.second_text(F.col("row_time"))).drop(
        "row_time", "arrival")


@query(f"WITH {o.DETAILS_ALL} SELECT sid, sc, count(*) AS views FROM order_views GROUP BY sid, sc")
def order_page_sources(spark, folder):
    views = changelog.order_page_sources(s.order_views(spark, folder))
    return views.groupBy("sid", "sc").agg(F.count("*").alias("views"))


def _details(spark, folder, sessions="latest") -> DataFrame:
    return facts.order_detail(s.change_log(spark, folder, "order_detail", "order_info"),
                              s.order_views(spark, folder), sessions)


def _stored_details(spark, folder, columns=()) -> DataFrame:
    """The order-detail table as the window jobs find it: written by the job before. With the
    ``columns`` of one window job, of all rows only what that job reads is joined and written."""
    details = _details(spark, folder)
    return stored(details.select(*jobs.detail_columns(columns)) if columns else details,
                  "order-detail")


@query(f"WITH {o.DETAILS} SELECT {o.DETAIL_COLUMNS} FROM details")
def fact_order_detail(spark, folder):
    return _fact(_details(spark, folder))


@query(f"""WITH {o.DETAILS_ALL}
SELECT {o.DETAIL_COLUMNS.replace('source', 'sc AS source')}
FROM lines JOIN order_views ON session_id = sid""")
def fact_order_detail_per_view(spark, folder):
    return _fact(_details(spark, folder, "all"))


@query(f"""WITH {o.DETAILS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY a DESC, b DESC, c DESC,
                               dd DESC, e DESC, f DESC) AS rn
  FROM details) SELECT {o.DETAIL_COLUMNS} FROM ranked WHERE rn = 1""")
def fact_order_detail_keyed(spark, folder):
    return _fact(latest_per_key(_details(spark, folder), "id"))


_DAYS_30 = 30 * 24 * 3600


def _payments_with_details(spark, folder, **bounds) -> DataFrame:
    return facts.payment_success(
        changelog.with_row_time(s.change_log(spark, folder, "payment_info")),
        changelog.with_row_time(_details(spark, folder)), **bounds)


@query(o.payment_success("15 MINUTES", "5 SECONDS"))
def fact_payment_success(spark, folder):
    return _fact(_payments_with_details(spark, folder))


@query(o.payment_success("30 DAYS", "30 DAYS"))
def fact_payment_success_30_days(spark, folder):
    return _fact(_payments_with_details(
        spark, folder, before_seconds=_DAYS_30, after_seconds=_DAYS_30))


@query(f"""WITH {o.DETAILS}, {o.PAYMENTS}, joined AS (
  SELECT paid.id, paid.order_id, total_amount, ts, d.id AS detail_id, user_id, course_id,
         course_name, origin_amount, coupon_reduce, final_amount, session_id, province_id,
         row_number() OVER (PARTITION BY paid.id ORDER BY a DESC, b DESC, c DESC,
                               dd DESC, e DESC, f DESC) AS rn
  FROM paid JOIN details d ON paid.order_id = d.order_id
   AND d.t BETWEEN pay_time - INTERVAL 30 DAYS AND pay_time + INTERVAL 30 DAYS)
SELECT * EXCLUDE (rn) FROM joined WHERE rn = 1""")
def fact_payment_success_keyed(spark, folder):
    return _fact(latest_per_key(_payments_with_details(
        spark, folder, before_seconds=_DAYS_30, after_seconds=_DAYS_30), "id"))


def _purchases_with_views(spark, folder, before: int, after: int) -> DataFrame:
    events = s.table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("t"))
    bought = events.where("event_type = 'purchase'").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("t").alias("bought_at"))
    seen = events.where("event_type = 'view'").select(
        "user_id", F.col("event_id").alias("view_id"), F.col("t").alias("seen_at"))
    pairs = interval_join(bought, seen, ["user_id"], "bought_at", "seen_at", before, after)
    return pairs.select("user_id", "purchase_id", "view_id")


def _purchases_with_views_sql(before: str, after: str) -> str:
    return f"""SELECT p.user_id, p.event_id AS purchase_id, v.event_id AS view_id
FROM events p JOIN events v ON p.user_id = v.user_id
 AND v.ts BETWEEN p.ts - INTERVAL {before} AND p.ts + INTERVAL {after}
WHERE p.event_type = 'purchase' AND v.event_type = 'view'"""


@query(_purchases_with_views_sql("15 MINUTES", "5 SECONDS"))
def interval_join_15_minutes(spark, folder):
    return _purchases_with_views(spark, folder, 15 * 60, 5)


@query(_purchases_with_views_sql("1 DAY", "1 HOUR"))
def interval_join_1_day(spark, folder):
    return _purchases_with_views(spark, folder, 24 * 3600, 3600)


# --- lookups ----------------------------------------------------------------------------------

def _exams(spark, folder) -> DataFrame:
    return changelog.exams(s.change_log(spark, folder, "test_exam")).drop("arrival")


def _suppliers(spark, folder) -> DataFrame:
    return s.table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"))


@query(_EXAMS.format(", s_name AS name", "JOIN supplier ON s_suppkey = o_custkey"))
def lookup_found(spark, folder):
    return enrich(_exams(spark, folder), _suppliers(spark, folder), "paper_id", {"name": "name"})


@query(_EXAMS.format("", "ANTI JOIN supplier ON s_suppkey = o_custkey"))
def lookup_missing(spark, folder):
    return without_dimension(_exams(spark, folder), _suppliers(spark, folder), "paper_id")


@query("""SELECT s_suppkey IS NOT NULL AS has_dimension, count(*) AS n, count(s_name) AS named
FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey WHERE o_orderstatus <> 'P' GROUP BY 1""")
def lookup_found_and_missing(spark, folder):
    marked = enrich_or_mark(_exams(spark, folder), _suppliers(spark, folder), "paper_id",
                            {"name": "name"})
    return marked.groupBy("has_dimension").agg(
        F.count("*").alias("n"), F.count("name").alias("named"))


# --- quarantine: rows with and without their dimension rows, from one pass ----------------------

def _balance(marked: DataFrame) -> DataFrame:
    missing = F.col("missing")
    return marked.agg(
        F.count("*").alias("rows_in"), F.count_if(missing.isNull()).alias("found"),
        F.count_if(missing.isNotNull()).alias("set_aside"))


@query(f"""WITH all_exams AS (
  SELECT CAST(o_custkey AS BIGINT) AS k FROM orders WHERE o_orderstatus <> 'P')
SELECT count(*) AS rows_in, count(s_suppkey) AS found,
       count(*) - count(s_suppkey) AS set_aside
FROM all_exams LEFT JOIN supplier ON s_suppkey = k""")
def quarantine_exam_paper(spark, folder):
    papers = _suppliers(spark, folder).withColumnRenamed("name", "course_id")
    return _balance(facts.exam_paper_marked(s.change_log(spark, folder, "test_exam"), papers))


@query("""SELECT count(*) AS rows_in, count(p_partkey) AS found,
       count(*) - count(p_partkey) AS set_aside
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_partkey % 3 <> 0) p ON p_partkey = l_partkey
WHERE l_returnflag <> 'A'""")
def quarantine_review(spark, folder):
    courses = s.course_info(spark, folder).where("CAST(id AS BIGINT) % 3 <> 0")
    return _balance(facts.review_marked(s.change_log(spark, folder, "review_info"), courses))


@query(f"""WITH {o.VIEWS}, {o.flags('views')}, {o.TRAFFIC}
SELECT count(*) AS rows_in, count_if(sc <> '3') AS found, count_if(sc = '3') AS set_aside
FROM traffic""")
def quarantine_traffic_windows(spark, folder):
    return _balance(jobs.traffic_marked(
        s.page_views(spark, folder), s.base_source(spark, folder).where("id <> '3'"),
        state.chunk_of("arrival")))


@query(f"""WITH {o.TRADE}
SELECT count(*) AS rows_in, count_if(sc <> '3' AND province_id <> '7') AS found,
       count_if(sc = '3' OR province_id = '7') AS set_aside FROM trade""")
def quarantine_trade_windows(spark, folder):
    return _balance(jobs.trade_marked(
        _stored_details(spark, folder, jobs.TRADE_COLUMNS),
        s.base_source(spark, folder).where("id <> '3'"),
        s.base_province(spark, folder).where("id <> '7'"), s.arrival_chunk()))


@query(f"""WITH {o.TRADE_FLAGS}, summed AS (
  SELECT {o.stamps('t')}, course_id FROM trade_flags GROUP BY ALL)
SELECT count(*) AS rows_in, count_if(CAST(course_id AS BIGINT) % 3 <> 0) AS found,
       count_if(CAST(course_id AS BIGINT) % 3 = 0) AS set_aside FROM summed""")
def quarantine_course_windows(spark, folder):
    courses = s.course_info(spark, folder).where("CAST(id AS BIGINT) % 3 <> 0")
    return _balance(jobs.course_marked(
        _stored_details(spark, folder, jobs.COURSE_COLUMNS), courses, s.subject_info(spark, folder),
        s.category_info(spark, folder), s.arrival_chunk()))


# --- state ------------------------------------------------------------------------------------

@query(f"WITH {o.VIEWS}, {o.REPAIRED} SELECT arrival, mid, is_new FROM repaired")
def new_visitor_repair(spark, folder):
    views = s.page_views(spark, folder).select("arrival", "mid", "is_new", "visit_date")
    return state.repair_new_visitor(views).drop("visit_date")


@query(f"""WITH {o.VIEWS}, {o.flags('views')}
SELECT arrival, mid, uv_ct, sv_ct, so_ct FROM flags""")
def visit_flags(spark, folder):
    views = s.page_views(spark, folder).select("arrival", "mid", "last_page_id", "visit_date")
    return state.visit_flags(views, state.chunk_of("arrival")).drop("visit_date", "last_page_id")


@query(f"""WITH {o.VIEWS}, {o.flags('views')}
SELECT arrival, mid, uv_ct, sv_ct, so_ct FROM flags""")
def visit_flags_small_chunks(spark, folder):
    """The same flags with every key taken as hot and its history cut into many chunks."""
    views = s.page_views(spark, folder).select("arrival", "mid", "last_page_id", "visit_date")
    return state.visit_flags(views, state.chunk_of("arrival", 97), hot_rows=0).drop(
        "visit_date", "last_page_id")


@query(f"""WITH {o.TRADE_FLAGS}
SELECT id, course_id, user_id, date_id, order_user_ct FROM trade_flags""")
def first_order_flag(spark, folder):
    rows = jobs.order_rows(_stored_details(spark, folder)).select(
        "id", "course_id", "user_id", "date_id", "order_date", "arrival")
    return state.daily_first_order_flag(rows, s.arrival_chunk()).drop("order_date", "arrival")


# --- windows ----------------------------------------------------------------------------------

def _traffic(spark, folder) -> DataFrame:
    return jobs.traffic_windows(s.page_views(spark, folder), s.base_source(spark, folder),
                                state.chunk_of("arrival"))


_TRAFFIC = f"WITH {o.VIEWS}, {o.flags('views')}, {o.TRAFFIC}"


@query(f"{_TRAFFIC} SELECT * FROM traffic")
def traffic_windows(spark, folder):
    return _traffic(spark, folder)


@query(f"""WITH {o.VIEWS} SELECT item AS keyword, count(*) AS keyword_count,
         {o.stamps("date_trunc('second', ts)", '%Y%m%d')}
FROM views WHERE event_type = 'click' GROUP BY ALL""")
def keyword_windows(spark, folder):
    log = s.page_log(spark, folder).withColumn(
        "row_time", scalars.millis_to_whole_second(F.col("ts")))
    return jobs.keyword_windows(log)


@query(f"""WITH {o.VIEWS} SELECT item AS keyword, count(*) AS searches,
       strftime(max(date_trunc('second', ts)), {o.SECOND}) AS last_at
FROM views WHERE event_type = 'click' GROUP BY item""")
def searches(spark, folder):
    found = windows.searches(s.page_log(spark, folder))
    return found.groupBy("keyword").agg(
        F.count("*").alias("searches"),
        scalars.second_text(F.max("row_time")).alias("last_at"))


def _trade(spark, folder) -> DataFrame:
    return jobs.trade_windows(_stored_details(spark, folder, jobs.TRADE_COLUMNS),
                              s.base_source(spark, folder), s.base_province(spark, folder), s.arrival_chunk())


@query(f"WITH {o.TRADE} SELECT * FROM trade")
def trade_windows(spark, folder):
    return _amounts_as_double(_trade(spark, folder), "order_amount")


@query(f"""WITH {o.TRADE_FLAGS}, subjects AS (
  SELECT p_brand, min(p_type) AS category_id FROM part GROUP BY p_brand)
SELECT {o.stamps('t')}, course_id, arg_min(course_name, (a, b, c, dd, e, f)) AS course_name,
       part.p_brand AS subject_id, lower(part.p_brand) AS subject_name, category_id,
       lower(category_id) AS category_name, {o.TRADE_SUMS}
FROM trade_flags JOIN part ON CAST(p_partkey AS VARCHAR) = course_id
JOIN subjects ON part.p_brand = subjects.p_brand
GROUP BY ALL""")
def course_windows(spark, folder):
    return _amounts_as_double(
        jobs.course_windows(_stored_details(spark, folder, jobs.COURSE_COLUMNS),
                            s.course_info(spark, folder),
                            s.subject_info(spark, folder), s.category_info(spark, folder),
                            s.arrival_chunk()),
        "order_amount")


# --- reports ----------------------------------------------------------------------------------

_TRAFFIC_WHERE = f"WHERE replace(cur_date, '-', '') = '{TRAFFIC_DAY}'"
_TRADE_WHERE = f"WHERE replace(cur_date, '-', '') = '{TRADE_DAY}'"
_BOUNCE = """source_name, CAST(CAST(coalesce(sum(so_ct) / nullif(sum(sv_ct), 0), 0)
  AS DECIMAL(16,2)) AS DOUBLE) AS jump_out"""
_VISITORS = "source_name, CAST(sum(uv_ct) AS BIGINT) AS uv"
_AMOUNT = "source_name AS sc, CAST(sum(order_amount) AS DOUBLE) AS amount"
_ORDERED = "source_name AS sc, CAST(sum(order_ct) AS BIGINT) AS ordered"
_PROVINCE = """SELECT province_name, CAST(sum(order_amount) AS DOUBLE) AS order_amount,
  CAST(sum(order_user_ct) AS BIGINT) AS order_user_ct, CAST(sum(order_ct) AS BIGINT) AS order_ct
  FROM trade {} GROUP BY province_name"""
# Sums of exact decimals, made double only at the end as the queries do.
_TRADE_EXACT = o.TRADE.replace(
    "CAST(sum(CAST(final_amount AS DECIMAL(16,2))) AS DOUBLE)",
    "sum(CAST(final_amount AS DECIMAL(16,2)))")


@query(f"{_TRAFFIC} {o.top(_BOUNCE, 'traffic', 'source_name', 'jump_out')}")
def bounce_rate_by_source(spark, folder):
    return _amounts_as_double(reports.bounce_rate_by_source(_traffic(spark, folder)), "jump_out")


@query(f"{_TRAFFIC} {o.top(_VISITORS, 'traffic', 'source_name', 'uv')}")
def visitors_by_source(spark, folder):
    return reports.visitors_by_source(_traffic(spark, folder))


@query(f"WITH {_TRADE_EXACT} {o.top(_AMOUNT, 'trade', 'source_name', 'amount')}")
def amount_by_source(spark, folder):
    return _amounts_as_double(reports.amount_by_source(_trade(spark, folder)), "amount")


@query(f"WITH {_TRADE_EXACT} {o.top(_ORDERED, 'trade', 'source_name', 'ordered')}")
def orders_by_source(spark, folder):
    return reports.orders_by_source(_trade(spark, folder))


@query(f"WITH {_TRADE_EXACT} {_PROVINCE.format('')}")
def trade_by_province(spark, folder):
    return _amounts_as_double(reports.trade_by_province(_trade(spark, folder)), "order_amount")


# The reports of one day read that day's partition of the stored window table. A session
# stores a table once.
_stored_reports: dict[tuple[str, str, str], str] = {}


def _day_of(spark, folder, name: str, build: Query, day: int) -> DataFrame:
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _stored_reports:
        path = work_folder(spark, f"report-{name}")
        sinks.write_batch(build(spark, folder), path, 0, ["cur_date"])
        _stored_reports[key] = path
    return report_day_partition(
        spark, _stored_reports[key], day, "run=*/batch_id=*").drop(*sinks.PLACE)


@query(f"{_TRAFFIC} {o.top(_BOUNCE, 'traffic', 'source_name', 'jump_out', where=_TRAFFIC_WHERE)}")
def day_bounce_rate_by_source(spark, folder):
    day = _day_of(spark, folder, "traffic", _traffic, TRAFFIC_DAY)
    return _amounts_as_double(reports.bounce_rate_by_source(day), "jump_out")


@query(f"{_TRAFFIC} {o.top(_VISITORS, 'traffic', 'source_name', 'uv', 3, _TRAFFIC_WHERE)}")
def day_visitors_by_source_top_3(spark, folder):
    return reports.visitors_by_source(_day_of(spark, folder, "traffic", _traffic, TRAFFIC_DAY), 3)


@query(f"WITH {_TRADE_EXACT} {o.top(_AMOUNT, 'trade', 'source_name', 'amount', 2, _TRADE_WHERE)}")
def day_amount_by_source_top_2(spark, folder):
    day = _day_of(spark, folder, "trade", _trade, TRADE_DAY)
    return _amounts_as_double(reports.amount_by_source(day, 2), "amount")


@query(f"WITH {_TRADE_EXACT} {o.top(_ORDERED, 'trade', 'source_name', 'ordered', where=_TRADE_WHERE)}")
def day_orders_by_source(spark, folder):
    return reports.orders_by_source(_day_of(spark, folder, "trade", _trade, TRADE_DAY))


@query(f"WITH {_TRADE_EXACT} {o.top(_ORDERED, 'trade', 'source_name', 'ordered', where=_TRADE_WHERE)}")
def day_conversion_by_source(spark, folder):
    return reports.conversion_by_source(_day_of(spark, folder, "trade", _trade, TRADE_DAY))


@query(f"WITH {_TRADE_EXACT} {_PROVINCE.format(_TRADE_WHERE)}")
def day_trade_by_province(spark, folder):
    day = _day_of(spark, folder, "trade", _trade, TRADE_DAY)
    return _amounts_as_double(reports.trade_by_province(day), "order_amount")


# --- behaviour log ----------------------------------------------------------------------------

def _split(spark, folder) -> DataFrame:
    return jobs.split_log(s.behaviour_log(spark, folder), s.log_tasks(spark, folder))


@query("""SELECT text AS value FROM documents
WHERE CASE WHEN json_valid(text) THEN json_type(text) <> 'OBJECT' ELSE true END""")
def dirty_records(spark, folder):
    return logsplit.dirty(logsplit.parse_log(s.behaviour_log(spark, folder))).select("value")


@query(f"""WITH {o.VIEWS}, {o.REPAIRED}, {o.SPLIT}
SELECT topic, arrival, repaired.mid, repaired.is_new, v.sc, v.page_id, v.last_page_id,
       v.during_time, pos, CASE WHEN pos IS NOT NULL THEN v.item END AS element_item,
       CASE WHEN has_ts THEN epoch_us(v.ts) // 1000 END AS ts,
       has_err, has_video, has_start
FROM outputs JOIN views v USING (arrival) JOIN repaired USING (arrival)""")
def log_split(spark, folder):
    shape = ("common map<string,string>, page map<string,string>, "
             "display struct<pos:bigint,item:string>, action struct<pos:bigint,item:string>, "
             "err string, appVideo string, start string, ts bigint")
    rows = _split(spark, folder).where(F.col("topic") != logsplit.DIRTY)
    r = rows.withColumn("r", F.from_json("value", shape)).select("topic", "arrival", "r.*")
    return r.select(
        "topic", "arrival",
        *[F.col("common")[n].alias(n) for n in ("mid", "is_new", "sc")],
        *[F.col("page")[n].alias(n) for n in ("page_id", "last_page_id")],
        F.col("page")["during_time"].cast("bigint").alias("during_time"),
        F.coalesce("display.pos", "action.pos").alias("pos"),
        F.coalesce("display.item", "action.item").alias("element_item"), "ts",
        F.col("err").isNotNull().alias("has_err"),
        F.col("appVideo").isNotNull().alias("has_video"),
        F.col("start").isNotNull().alias("has_start"))


@query(f"""WITH {o.VIEWS}, {o.SPLIT}, all_rows AS (
  SELECT topic FROM outputs UNION ALL SELECT 'dirty_topic' FROM documents
  WHERE CASE WHEN json_valid(text) THEN json_type(text) <> 'OBJECT' ELSE true END)
SELECT topic, count(*) AS records FROM all_rows GROUP BY topic""")
def log_split_counts(spark, folder):
    return _split(spark, folder).groupBy("topic").agg(F.count("*").alias("records"))


@query("""WITH texts AS (
  SELECT text AS t FROM documents UNION ALL SELECT html FROM pages
  UNION ALL SELECT text FROM conversations)
SELECT (SELECT count(*) FROM events) + (SELECT count(*) FROM texts) AS records_in,
       (SELECT count(*) FROM events WHERE event_type = 'purchase') AS video,
       (SELECT count(*) FROM events WHERE event_type = 'view') AS started,
       (SELECT count(*) FROM events WHERE event_type NOT IN ('purchase', 'view')) AS page,
       (SELECT count(*) FROM texts) AS dirty""")
def log_rows_conserved(spark, folder):
    """Records in are dirty, video, start or page records: none is lost, none is in two."""
    odd = [s.table(spark, folder, name).select(F.col(column).alias("value"))
           for name, column in (("pages", "html"), ("conversations", "text"))]
    log = s.behaviour_log(spark, folder)
    for number, texts in enumerate(odd):
        log = log.unionByName(texts.withColumn("arrival", F.lit(-1 - number).cast("bigint")))
    kinds = {"dirty": logsplit.DIRTY, "video": logsplit.APP_VIDEO, "started": logsplit.START,
             "page": logsplit.PAGE}
    out = jobs.split_log(log, s.log_tasks(spark, folder)).agg(*[
        F.count_if(F.col("topic") == topic).alias(name) for name, topic in kinds.items()])
    return log.agg(F.count("*").alias("records_in")).join(out)


@query(f"""WITH {o.VIEWS}, {o.REPAIRED}, pages AS (
  SELECT v.* REPLACE (r.is_new AS is_new) FROM views v JOIN repaired r USING (arrival)
  WHERE event_type NOT IN ('purchase', 'view')), {o.flags('pages')}, {o.TRAFFIC}
SELECT * FROM traffic""")
def traffic_windows_from_log(spark, folder):
    """From raw log text to the traffic window table."""
    pages = stored(_split(spark, folder).where(F.col("topic") == logsplit.PAGE), "page-log")
    return jobs.traffic_windows(logsplit.page_views(pages), s.base_source(spark, folder),
                                state.chunk_of("arrival"))


# --- dimensions -------------------------------------------------------------------------------

_CONFIG = """config AS (
  SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'd' WHEN 'F' THEN 'u' ELSE 'c'
         END AS op, o_orderpriority FROM orders)"""


@query(f"""WITH {_CONFIG}, last AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM config)
SELECT 'src_' || o_custkey AS source_table, 'dim_' || o_custkey AS sink_table,
       'info' AS sink_family, 'id,' || o_orderpriority AS sink_columns, 'id' AS sink_row_key
FROM last WHERE rn = 1 AND op <> 'd'""")
def dimension_config_now(spark, folder):
    return dims.current_config(dims.config_changes(s.config_records(spark, folder)))


@query(f"""WITH {_CONFIG} SELECT op, 'src_' || o_custkey AS source_table,
       'dim_' || o_custkey AS sink_table, 'info' AS sink_family,
       'id,' || o_orderpriority AS sink_columns, 'id' AS sink_row_key, o_orderkey AS arrival
FROM config""")
def dimension_config_from_json(spark, folder):
    """Captured changes of the configuration table, as their JSON text."""
    topic = s.config_records(spark, folder).select(
        F.to_json(F.struct("op", "before", "after")).alias("value"), "arrival")
    return dims.config_changes(config_records(topic))


@query(f"""WITH {_CONFIG}, last AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM config)
SELECT 'src_' || c_custkey AS source_table, 'dim_' || c_custkey AS sink_table,
       'info' AS sink_family, coalesce('id,' || o_orderpriority, 'id,first') AS sink_columns,
       'id' AS sink_row_key
FROM customer LEFT JOIN last ON o_custkey = c_custkey AND rn = 1
WHERE op IS DISTINCT FROM 'd'""")
def dimension_config_preloaded(spark, folder):
    """A configuration read whole at start, a row per customer, and its changes since."""
    whole = s.table(spark, folder, "customer").select(
        F.concat(F.lit("src_"), F.col("c_custkey")).alias("source_table"),
        F.concat(F.lit("dim_"), F.col("c_custkey")).alias("sink_table"),
        F.lit("info").alias("sink_family"), F.lit("id,first").alias("sink_columns"),
        F.lit("id").alias("sink_row_key"))
    changes = dims.config_changes(s.config_records(spark, folder))
    start = dims.preloaded(whole, F.lit(-1).cast(changes.schema["arrival"].dataType))
    return dims.current_config(start.unionByName(changes))


@query(f"""WITH {_CONFIG} SELECT 'dim_' || o_custkey AS sink_table, max(o_orderkey) AS reset_at
FROM config WHERE op IN ('u', 'd') GROUP BY 1""")
def dimension_resets(spark, folder):
    return dims.resets(dims.config_changes(s.config_records(spark, folder)))


def _routed(spark, folder) -> DataFrame:
    config = dims.current_config(s.dimension_config(spark))
    return dims.route(s.dimension_changes(spark, folder), config)


_ROUTED = f"""routed AS (
  SELECT 'dim_buyer' AS sink_table, CAST(o_custkey AS VARCHAR) AS row_key,
         CASE WHEN o_orderstatus = 'P' THEN 'update' ELSE 'insert' END AS op,
         CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS x,
         CASE WHEN o_orderstatus <> 'O' THEN {o.money('o_totalprice')} END AS y,
         o_orderkey AS arrival FROM orders
  UNION ALL
  SELECT 'dim_user', CAST(user_id AS VARCHAR),
         CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'bootstrap-insert'
           ELSE 'update' END,
         CASE WHEN event_type <> 'purchase' THEN event_type END,
         CASE WHEN event_type <> 'click' THEN CAST(json_extract(props, '$.k') AS VARCHAR) END,
         event_id FROM events)"""


def _two_columns(df: DataFrame) -> DataFrame:
    """The kept columns of both dimensions side by side, apart from the key."""
    cols = F.col("cols")
    return df.withColumns({
        "x": F.coalesce(cols["priority"], cols["level"]),
        "y": F.coalesce(cols["amount"], cols["score"]),
        "id": cols["id"], "note": cols["note"]}).drop("cols")


@query(f"""WITH {_ROUTED}
SELECT sink_table, row_key, op, x, y, arrival, row_key AS id, CAST(NULL AS VARCHAR) AS note
FROM routed""")
def dimension_rows_routed(spark, folder):
    return _two_columns(_routed(spark, folder))


_APPLIED = """kept AS (SELECT * FROM routed {}),
deleted AS (SELECT sink_table, row_key, max(arrival) AS deleted_at FROM kept WHERE op = 'delete'
            GROUP BY ALL),
alive AS (
  SELECT kept.* FROM kept LEFT JOIN deleted USING (sink_table, row_key)
  WHERE op <> 'delete' AND (deleted_at IS NULL OR arrival > deleted_at))
SELECT sink_table, row_key, arg_max(x, arrival) FILTER (x IS NOT NULL) AS x,
       arg_max(y, arrival) FILTER (y IS NOT NULL) AS y, row_key AS id,
       CAST(NULL AS VARCHAR) AS note
FROM alive GROUP BY sink_table, row_key"""


@query(f"WITH {_ROUTED}, {_APPLIED.format('')}")
def dimension_tables(spark, folder):
    return _two_columns(dims.apply_changes(_routed(spark, folder)))


@query(f"WITH {_ROUTED}, {_APPLIED.format('WHERE sink_table = $$dim_user$$ OR arrival > 100')}"
       .replace("$$", "'"))
def dimension_tables_after_reset(spark, folder):
    resets = dims.resets(s.dimension_config(spark))
    return _two_columns(dims.apply_changes(dims.after_reset(_routed(spark, folder), resets)))


# --- as of arrival ------------------------------------------------------------------------------

_SHIFTING = f"""shifting AS (
  SELECT CAST(o_orderkey AS BIGINT) AS at,
         CASE WHEN o_custkey % 2 = 0 THEN 'buyer' ELSE 'user' END AS source_table,
         CASE o_orderstatus WHEN 'P' THEN 'd' WHEN 'F' THEN 'u' ELSE 'c' END AS c_op,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'id,priority,amount,level,score'
           WHEN '2' THEN 'id,priority,level' WHEN '3' THEN 'id,amount,score' ELSE 'id' END AS names
  FROM orders),
{_ROUTED},
routed_as_of AS (
  SELECT sink_table, row_key, op, arrival,
         CASE WHEN contains(names, CASE sink_table WHEN 'dim_buyer' THEN 'priority' ELSE 'level' END)
           THEN x END AS x,
         CASE WHEN contains(names, CASE sink_table WHEN 'dim_buyer' THEN 'amount' ELSE 'score' END)
           THEN y END AS y
  FROM (SELECT *, CAST(arrival AS BIGINT) AS n, substr(sink_table, 5) AS source_table FROM routed) r
  ASOF JOIN shifting s ON r.source_table = s.source_table AND r.n >= s.at
  WHERE c_op <> 'd')"""


def _routed_as_of(spark, folder, **options) -> DataFrame:
    config = dims.config_changes(s.shifting_config(spark, folder))
    return dims.route_as_of(s.dimension_changes(spark, folder), config, **options)


@query(f"""WITH {_SHIFTING}
SELECT sink_table, row_key, op, x, y, arrival, row_key AS id, CAST(NULL AS VARCHAR) AS note
FROM routed_as_of""")
def dimension_rows_as_of_config(spark, folder):
    return _two_columns(_routed_as_of(spark, folder))


@query(f"""WITH {_SHIFTING}
SELECT sink_table, row_key, op, x, y, arrival, row_key AS id, CAST(NULL AS VARCHAR) AS note
FROM routed_as_of""")
def dimension_rows_as_of_config_in_chunks(spark, folder):
    """The same with every source table taken as hot, cut into chunks of 512 arrivals."""
    return _two_columns(_routed_as_of(spark, folder, span=512, hot_rows=0))


# Both lookups see the user dimension, whose rows change and go with the events, as it was.
_USER_VERSIONS = f"""{_ROUTED},
lives AS (
  SELECT row_key AS id, arrival, op = 'delete' AS gone, x, y,
         count(*) FILTER (op = 'delete') OVER (PARTITION BY row_key ORDER BY arrival) AS life
  FROM routed WHERE sink_table = 'dim_user'),
versions AS (
  SELECT id, CAST(arrival AS BIGINT) AS arrival, gone,
         last_value(CASE WHEN NOT gone THEN x END IGNORE NULLS) OVER w AS level,
         last_value(CASE WHEN NOT gone THEN y END IGNORE NULLS) OVER w AS score
  FROM lives WINDOW w AS (PARTITION BY id, life ORDER BY arrival
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _user_versions(spark, folder) -> DataFrame:
    return asof.dimension_versions(_routed(spark, folder), "dim_user", "level", "score")


@query(f"""WITH {_USER_VERSIONS} SELECT id, arrival, NOT gone AS alive, level, score FROM versions""")
def dimension_versions(spark, folder):
    return _user_versions(spark, folder)


@query(f"""WITH {_USER_VERSIONS}, e AS (
  {_EXAMS.format(", CAST(o_orderkey AS BIGINT) AS a", "")})
SELECT e.id, e.paper_id, e.user_id, e.score, e.duration_sec, e.create_time, v.score AS course_id
FROM e ASOF JOIN versions v ON v.id = e.paper_id AND e.a >= v.arrival WHERE NOT v.gone""")
def fact_exam_paper_as_of(spark, folder):
    papers = _user_versions(spark, folder).withColumnRenamed("score", "course_id")
    return _fact(facts.exam_paper_as_of(
        s.change_log(spark, folder, "test_exam"), papers, F.col("arrival.a")))


@query(f"""WITH {_USER_VERSIONS}, r AS (
  SELECT {o.LINE_ID} AS id, CAST(l_suppkey AS VARCHAR) AS user_id,
         CAST(l_partkey AS VARCHAR) AS course_id, CAST(l_linenumber AS VARCHAR) AS review_stars,
         {o.EPOCH.format('l_shipdate')} AS ts, CAST(l_orderkey AS BIGINT) AS a
  FROM lineitem WHERE l_returnflag <> 'A')
SELECT r.* EXCLUDE (a), v.level AS course_name
FROM r ASOF JOIN versions v ON v.id = r.course_id AND r.a >= v.arrival WHERE NOT v.gone""")
def fact_review_as_of(spark, folder):
    """With every course taken as hot, its history cut into many chunks."""
    courses = _user_versions(spark, folder).withColumnRenamed("level", "course_name")
    return _fact(facts.review_as_of(
        s.change_log(spark, folder, "review_info"), courses, F.col("arrival.a"),
        span=1024, hot_rows=0))


# --- scalar functions -------------------------------------------------------------------------

@query(f"""SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, {o.SECOND}) AS second,
       strftime(ts, '%Y%m%d') AS compact,
       strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before,
       CAST(epoch_ms(date_trunc('day', ts)) AS BIGINT) AS day_ms,
       CAST(epoch_ms(date_trunc('second', ts)) AS BIGINT) AS second_ms,
       strftime(date_trunc('second', ts), {o.SECOND}) AS whole_second
FROM events""")
def time_texts(spark, folder):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    time = scalars.millis_to_time(ms)
    return s.table(spark, folder, "events").select(
        "event_id", scalars.day_text(time).alias("day"),
        scalars.second_text(time).alias("second"),
        scalars.compact_day_text(time).alias("compact"),
        scalars.day_text(F.date_sub(F.to_date(time), 1)).alias("day_before"),
        scalars.text_to_millis(scalars.day_text(time)).alias("day_ms"),
        scalars.text_to_millis(scalars.second_text(time), with_time=True).alias("second_ms"),
        scalars.second_text(scalars.millis_to_whole_second(ms)).alias("whole_second"))


# --- streams ----------------------------------------------------------------------------------
# Each runs a streaming job over all that is there, and reads back what it wrote. Windows
# show once the watermark has passed their end, so the checks leave out the last ones.

def _streamed(stream: DataFrame, name: str) -> DataFrame:
    spark = stream.sparkSession
    folder = work_folder(spark, name)
    query = sinks.start(stream, sinks.keyed_writer(f"{folder}/out"), f"{folder}/checkpoint",
                        every=None)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out").drop(*sinks.PLACE)


def _flagged(rows: DataFrame, writer, flags, chunk, name: str) -> DataFrame:
    """A stream of the rows with the flags that ``writer`` adds, as the job before wrote them."""
    spark, own = rows.sparkSession, work_folder(rows.sparkSession, name)
    sinks.start(rows, writer(f"{own}/out", f"{own}/last", chunk=chunk, idle_ms=None, buckets=BUCKETS),
                f"{own}/checkpoint", every=None).awaitTermination()
    schema = StructType([*rows.schema, *[StructField(f, LongType()) for f in flags]])
    return read_folder(spark, f"{own}/out/run=*/batch_id=*", schema, s.ONE_BATCH)


def _summed_per_batch(stream: DataFrame, writer, sums, name: str) -> DataFrame:
    """Window rows of a stream that is cut into micro-batches, added up over the batches. The
    first two are folded when the second is there; the others stand beside that. ``writer`` gives
    the writer of the parts below one folder, what it keeps between batches below another."""
    spark, folder = stream.sparkSession, work_folder(stream.sparkSession, name)
    out, folded = f"{folder}/out", f"{folder}/folded"
    write_parts = writer(out, f"{folder}/kept")

    def write(df, batch_id, run=""):
        write_parts(df, batch_id, run)
        if batch_id == 1:
            sinks.fold_windows(spark, out, sums, folded)

    sinks.start(stream, write, f"{folder}/checkpoint", every=None).awaitTermination()
    return sinks.read_windows(spark, out, sums, folded)


_CLOSED = "WHERE strptime(edt, '%Y-%m-%d %H:%M:%S') <= (SELECT max({}) - INTERVAL {} FROM {})"


@query(f"{_TRAFFIC} SELECT * FROM traffic {_CLOSED.format('ts', '2 SECONDS', 'views')}")
def stream_traffic_windows(spark, folder):
    views = s.page_views(spark, folder, s.events_stream(spark, folder))
    flagged = _flagged(views.select(*jobs.TRAFFIC_COLUMNS), carried.visit_flags_writer,
                       ["uv_ct", "sv_ct", "so_ct"], state.chunk_of("arrival"), "stream-visits")
    summed = _streamed(streams.traffic_windows_of_flags(flagged), "stream-traffic")
    return enrich(summed, s.base_source(spark, folder), "sc", {"source_site": "source_name"})


@query(f"""WITH {o.VIEWS}, clicks AS (
  SELECT *, date_trunc('second', ts) AS t FROM views WHERE event_type = 'click'),
counted AS (
  SELECT item AS keyword, count(*) AS keyword_count, {o.stamps('t', '%Y%m%d')}
  FROM clicks GROUP BY ALL)
SELECT * FROM counted {_CLOSED.format('t', '0 SECONDS', 'clicks')}""")
def stream_keyword_windows(spark, folder):
    log = s.page_log(spark, folder, s.events_stream(spark, folder)).withColumn(
        "row_time", scalars.millis_to_whole_second(F.col("ts")))
    return _streamed(streams.keyword_windows(log), "stream-keyword")


@query(f"""WITH {o.TRADE_FLAGS}, summed AS (
  SELECT {o.stamps('t')}, source AS sc, province_id, {o.TRADE_SUMS}
  FROM trade_flags GROUP BY ALL)
SELECT * FROM summed {_CLOSED.format('t', '2 SECONDS', 'trade_flags')}""")
def stream_trade_windows(spark, folder):
    """The second of two jobs: it reads the stored order-detail table as a stream."""
    path = work_folder(spark, "stream-order-detail")
    details = _details(spark, folder).select(*jobs.detail_columns(jobs.TRADE_COLUMNS))
    details.write.parquet(path)
    rows = jobs.order_rows(read_folder(spark, path, details.schema, s.ONE_BATCH)).select(
        *jobs.TRADE_COLUMNS, "order_date")
    flagged = _flagged(rows, carried.first_order_writer, ["order_user_ct"], s.arrival_chunk(),
                       "stream-first-orders")
    summed = streams.trade_windows_of_flags(flagged)
    return _amounts_as_double(_streamed(summed, "stream-trade"), "order_amount")


# The same over four micro-batches, whose rows are in order of arrival but not of time: all
# windows are whole, and no row is too late.

def _views_in_files(spark, folder, name: str) -> DataFrame:
    events = s.table(spark, folder, "events")
    return s.in_files(events, "event_id", work_folder(spark, name))


@query(f"{_TRAFFIC} SELECT * FROM traffic")
def stream_traffic_windows_in_batches(spark, folder):
    views = s.page_views(spark, folder, _views_in_files(spark, folder, "views-in-files"))
    summed = _summed_per_batch(
        views.select(*jobs.TRAFFIC_COLUMNS), lambda out, kept: carried.visit_flags_writer(
            out, kept, chunk=state.chunk_of("arrival"), idle_ms=None, buckets=BUCKETS,
            finish=lambda rows: windows.traffic_by_source_and_visitor(windows.traffic_measures(rows))),
        windows.TRAFFIC_SUMS, "stream-traffic-batches")
    return enrich(summed, s.base_source(spark, folder), "sc", {"source_site": "source_name"})


@query(f"""WITH {o.VIEWS} SELECT item AS keyword, count(*) AS keyword_count,
         {o.stamps("date_trunc('second', ts)", '%Y%m%d')}
FROM views WHERE event_type = 'click' GROUP BY ALL""")
def stream_keyword_windows_in_batches(spark, folder):
    log = s.page_log(spark, folder, _views_in_files(spark, folder, "log-in-files")).withColumn(
        "row_time", scalars.millis_to_whole_second(F.col("ts")))
    return _summed_per_batch(windows.searches(log), lambda out, _: sinks.window_parts_writer(
        out, windows.keyword_counts), ["keyword_count"], "stream-keyword-batches")


@query(f"""WITH {o.VIEWS}, clicks AS (
  SELECT item AS keyword, ts, arrival % 4 AS batch, {o.stamps("date_trunc('second', ts)", '%Y%m%d')},
         time_bucket(INTERVAL 10 SECONDS, date_trunc('second', ts)) + INTERVAL 10 SECONDS AS ends
  FROM views WHERE event_type = 'click'),
reached AS (SELECT batch, max(date_trunc('second', ts)) AS newest FROM clicks GROUP BY batch),
marks AS (
  SELECT b.batch, (SELECT max(newest) FROM reached r WHERE r.batch < b.batch) AS reached
  FROM reached b)
SELECT keyword, stt, edt, cur_date, coalesce(ends <= reached, false) AS late, count(*) AS n
FROM clicks JOIN marks USING (batch) GROUP BY ALL""")
def stream_keyword_windows_and_late_rows(spark, folder):
    """Four micro-batches that each hold rows of all times, so most of the later ones come behind
    the watermark. Windows and late rows together are all searches."""
    own = work_folder(spark, "stream-late")
    events = s.table(spark, folder, "events").withColumn("share", F.col("event_id") % 4)
    values = sorted(r.share for r in events.select("share").distinct().collect()
                    if r.share is not None)  # at most seven
    log = s.page_log(spark, folder, s.in_files(
        events, "share", f"{own}/in", cuts=values[:-1])).withColumn(
        "row_time", scalars.millis_to_whole_second(F.col("ts")))
    sinks.start(windows.searches(log), sinks.windows_and_late_writer(
        f"{own}/out", f"{own}/late", f"{own}/marks", "row_time", windows.keyword_counts,
        disorder_seconds=0), f"{own}/checkpoint", every=None).awaitTermination()
    counted = sinks.read_windows(spark, f"{own}/out", ["keyword_count"])
    late = windows.keyword_counts(spark.read.parquet(f"{own}/late"))
    both = counted.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))
    return both.withColumnRenamed("keyword_count", "n")


@query(f"WITH {o.TRADE} SELECT * FROM trade")
def stream_trade_windows_in_batches(spark, folder):
    details = jobs.order_rows(_stored_details(spark, folder, jobs.TRADE_COLUMNS)).select(
        *jobs.TRADE_COLUMNS, "order_date", "arrival.a")
    rows = s.in_files(details, "a", work_folder(spark, "details-in-files")).drop("a")
    summed = _summed_per_batch(
        rows, lambda out, kept: carried.first_order_writer(
            out, kept, chunk=s.arrival_chunk(), idle_ms=None, buckets=BUCKETS,
            finish=lambda flagged: windows.trade_by_source_and_province(
                windows.trade_measures(flagged))),
        ["order_ct", "order_user_ct", "order_amount"], "stream-trade-batches")
    return _amounts_as_double(
        jobs.name_trade(summed, s.base_source(spark, folder), s.base_province(spark, folder)),
        "order_amount")


@query(f"""WITH {o.VIEWS}, {o.REPAIRED}, {o.flags('views')}
SELECT arrival, r.mid, r.is_new, uv_ct, sv_ct, so_ct FROM repaired r JOIN flags USING (arrival)""")
def stream_visit_flags_and_repair(spark, folder):
    """Four micro-batches; the memory of the row before is a kept table of last rows. Both jobs
    write from one stream, which reads a micro-batch once."""
    views = s.page_views(spark, folder, _views_in_files(spark, folder, "flags-in-files")).select(
        "arrival", "mid", "is_new", "visit_date", "last_page_id")
    own = work_folder(spark, "stream-flags")
    chunk = state.chunk_of("arrival", 1 << 10)
    sinks.start(views, carried.together(
        carried.visit_flags_writer(
            f"{own}/flags", f"{own}/last", chunk=chunk, hot_rows=100, buckets=BUCKETS,
            finish=lambda rows: rows.select("arrival", "uv_ct", "sv_ct", "so_ct")),
        carried.repair_writer(
            f"{own}/repaired", f"{own}/first", hot_rows=100, buckets=BUCKETS,
            finish=lambda rows: rows.select("arrival", "mid", "is_new"))),
        f"{own}/checkpoint", every=None).awaitTermination()
    flagged, fixed = (spark.read.parquet(f"{own}/{name}") for name in ("flags", "repaired"))
    return fixed.select("arrival", "mid", "is_new").join(
        flagged.select("arrival", "uv_ct", "sv_ct", "so_ct"), "arrival")


@query(f"""WITH {o.DETAILS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY a DESC, b DESC, c DESC,
                               dd DESC, e DESC, f DESC) AS rn
  FROM details) SELECT {o.DETAIL_COLUMNS} FROM ranked WHERE rn = 1""")
def stream_fact_order_detail_keyed(spark, folder):
    """Four micro-batches merged by key; a read opens a bounded number of folders per bucket."""
    own = work_folder(spark, "stream-keyed")
    details = _stored_details(spark, folder).withColumn("n", F.pmod(F.xxhash64("id", "arrival"), F.lit(
        1 << 20)))
    rows = s.in_files(details, "n", f"{own}/in")
    schema = details.drop("n").schema
    sinks.start(rows, carried.keyed_merge_writer(f"{own}/out", ["id"], schema, BUCKETS),
                f"{own}/checkpoint", every=None).awaitTermination()
    return _fact(carried.read_merged(spark, f"{own}/out", ["id"], schema, BUCKETS))


@query(f"""WITH {o.DETAILS_ALL}
SELECT {o.DETAIL_COLUMNS.replace('source', 'sc AS source')}
FROM lines JOIN order_views ON session_id = sid""")
def stream_order_detail_per_view(spark, folder):
    """Three inputs whose rows wait for each other, an hour of wall clock at most. Lines wait without
    their place in the log, which the rows of the result do not have."""
    own = work_folder(spark, "stream-orders")
    names = ("line", "header", "view")

    def split(df):
        return [df.where(F.col(n).isNotNull()).select(f"{n}.*").drop("arrival") for n in names]

    for rows in s.order_facts_in_files(spark, folder, f"{own}/in"):
        write = carried.order_detail_writer(
            f"{own}/out", f"{own}/waiting", split, facts.with_day,
            [part.schema for part in split(rows)], ttl_ms=3_600_000, buckets=BUCKETS, reread=True)
        sinks.start(rows, write, f"{own}/checkpoint", every=None).awaitTermination()
    return _fact(spark.read.parquet(f"{own}/out").drop(*sinks.PLACE))


@query(_EXAMS.format(""", s_name AS name,
       CASE WHEN s_suppkey IS NULL THEN 'parked' ELSE 'found' END AS state""",
                     "LEFT JOIN supplier ON s_suppkey = o_custkey"))
def stream_lookup_of_late_dimension(spark, folder):
    """A dimension whose rows come over four batches; rows wait for theirs. None is lost."""
    own = work_folder(spark, "stream-parked")
    exams = _exams(spark, folder).withColumn("n", F.pmod(F.xxhash64("id"), F.lit(1 << 20)))
    rows = s.in_files(exams, "n", f"{own}/in").drop("n")
    dim = stored(_suppliers(spark, folder), "suppliers")
    write = carried.parked_lookup_writer(
        f"{own}/out", f"{own}/parked", f"{own}/late",
        lambda batch: dim.where(F.pmod(F.xxhash64("id"), F.lit(4)) <= batch), "paper_id",
        {"name": "name"}, wait_ms=3_600_000, buckets=BUCKETS)
    sinks.start(rows, write, f"{own}/checkpoint", every=None).awaitTermination()
    found = spark.read.parquet(f"{own}/out").drop(*sinks.PLACE).withColumn("state", F.lit("found"))
    kept = carried.parked(spark, f"{own}/parked", exams.drop("n").schema, "paper_id", BUCKETS)
    late = spark.read.schema(exams.drop("n").schema).parquet(f"{own}/late").drop(*sinks.PLACE)
    return (found.unionByName(kept.withColumn("state", F.lit("parked")), allowMissingColumns=True)
            .unionByName(late.withColumn("state", F.lit("set aside")), allowMissingColumns=True))


@query(f"""WITH {_SHIFTING}
SELECT sink_table, row_key, op, x, y, arrival, row_key AS id, CAST(NULL AS VARCHAR) AS note
FROM routed_as_of""")
def stream_dimension_rows_as_of_config(spark, folder):
    """Changes and configuration as two streams, cut into files of their own. Routing goes by
    arrival when the logs are read, so it does not matter which input was ahead."""
    own = work_folder(spark, "stream-routed")
    changes = s.dimension_changes(spark, folder)
    config = dims.config_changes(s.shifting_config(spark, folder))
    for name, rows, cuts in (("changes", changes, 4), ("config", config, 3)):
        stream = s.in_files(rows, "arrival", f"{own}/{name}-in", cuts)
        sinks.start(stream, sinks.keyed_writer(f"{own}/{name}"), f"{own}/checkpoint-{name}",
                    every=None).awaitTermination()
    return _two_columns(sinks.read_routed(spark, f"{own}/changes", f"{own}/config"))


@query(f"WITH {_ROUTED}, {_APPLIED.format('WHERE sink_table = $$dim_user$$ OR arrival > 100')}"
       .replace("$$", "'"))
def stream_dimension_tables_after_reset(spark, folder):
    """The dimension log over four batches, with a snapshot between them that holds rows from
    before the reset."""
    own = work_folder(spark, "stream-dimensions")
    config = stored(s.dimension_config(spark), "config")
    log, snapshots = f"{own}/log", f"{own}/snapshots"
    route = sinks.dimension_writer(log, lambda: dims.current_config(config))

    def write(df, batch_id, run=""):
        route(df, batch_id, run)
        if batch_id == 1:
            sinks.compact_dimensions(spark, log, snapshots)

    stream = s.in_files(s.dimension_changes(spark, folder), "arrival", f"{own}/in")
    sinks.start(stream, write, f"{own}/checkpoint", every=None).awaitTermination()
    return _two_columns(sinks.read_dimensions(spark, log, dims.resets(config), snapshots))


@query(_purchases_with_views_sql("1 DAY", "1 HOUR"))
def stream_interval_join(spark, folder):
    events = s.events_stream(spark, folder).select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("t"))
    bought = events.where("event_type = 'purchase'").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("t").alias("bought_at")
    ).withWatermark("bought_at", streams.NO_DISORDER)
    seen = events.where("event_type = 'view'").select(
        "user_id", F.col("event_id").alias("view_id"), F.col("t").alias("seen_at")
    ).withWatermark("seen_at", streams.NO_DISORDER)
    pairs = interval_join(bought, seen, ["user_id"], "bought_at", "seen_at", 24 * 3600, 3600)
    return _streamed(pairs.select("user_id", "purchase_id", "view_id"), "stream-interval")
