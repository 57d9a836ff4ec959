"""The warehouse jobs on whole tables: from facts to window tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill.functions.scalars import seconds_to_time
from coursemill.operators import logsplit, state, windows
from coursemill.operators.enrich import enrich, enrich_chain, enrich_chain_or_mark

TRAFFIC_COLUMNS = ("mid", "sc", "is_new", "last_page_id", "during_time", "visit_date",
                   "row_time", "arrival")
TRADE_COLUMNS = ("user_id", "sc", "province_id", "final_amount", "row_time", "arrival")
COURSE_COLUMNS = ("user_id", "course_id", "course_name", "final_amount", "row_time", "arrival")

# Names of the window jobs' columns in the order-detail table, where they are others.
_STORED_AS = {"sc": "source", "row_time": "ts"}


def detail_columns(columns: tuple[str, ...]) -> list[str]:
    """What of the order-detail table gives a window job its columns; see :func:`order_rows`."""
    return [_STORED_AS.get(c, c) for c in columns]


def split_log(log: DataFrame, tasks: int = 0) -> DataFrame:
    """Behaviour log (value, arrival) to (topic, value) rows, dirty rows included.

    Splitting a record takes long for its bytes, and Spark sizes tasks by bytes. With ``tasks``,
    repaired records are dealt to so many, if these are more than there are cores.
    """
    parsed = logsplit.parse_log(log)
    repaired = state.repair_new_visitor(logsplit.usable(parsed))
    if tasks > log.sparkSession.sparkContext.defaultParallelism:
        repaired = repaired.repartition(tasks, *[c for c in ("arrival",) if c in log.columns] or ["value"])
    return logsplit.split(repaired).unionByName(logsplit.dirty(parsed))


def traffic_flags(page_views: DataFrame, chunk: Column) -> DataFrame:
    """Page views with visitor, session and bounce flags; only what the windows need travels."""
    return windows.traffic_measures(
        state.visit_flags(page_views.select(*TRAFFIC_COLUMNS), chunk))


def traffic_windows(page_views: DataFrame, base_source: DataFrame, chunk: Column) -> DataFrame:
    """dws_traffic_sc_is_new_window. The name is looked up after summing: few rows."""
    summed = windows.traffic_by_source_and_visitor(traffic_flags(page_views, chunk))
    return enrich(summed, base_source, "sc", {"source_site": "source_name"})


def keyword_windows(page_log: DataFrame) -> DataFrame:
    """dws_traffic_source_keyword_page_view_window."""
    return windows.keyword_counts(windows.searches(page_log))


def order_rows(details: DataFrame) -> DataFrame:
    """Order-detail rows with event time, day and source under the window jobs' names."""
    time = seconds_to_time(F.col("ts"))
    return details.withColumnRenamed("source", "sc").withColumns(
        {"row_time": time, "order_date": F.to_date(time)})


def trade_flags(details: DataFrame, chunk: Column, columns=TRADE_COLUMNS) -> DataFrame:
    rows = order_rows(details).select(*columns, "order_date")
    return windows.trade_measures(state.daily_first_order_flag(rows, chunk))


def trade_windows(details: DataFrame, base_source: DataFrame, base_province: DataFrame,
                  chunk: Column) -> DataFrame:
    """dws_trade_sc_ar_window."""
    return name_trade(windows.trade_by_source_and_province(trade_flags(details, chunk)),
                      base_source, base_province)


def trade_steps(base_source: DataFrame, base_province: DataFrame) -> tuple:
    return ((base_source, "sc", {"source_site": "source_name"}),
            (base_province, "province_id", {"name": "province_name"}))


def name_trade(summed: DataFrame, base_source: DataFrame, base_province: DataFrame) -> DataFrame:
    return enrich_chain(summed, *trade_steps(base_source, base_province))


def course_windows(details: DataFrame, course_info: DataFrame, subject_info: DataFrame,
                   category_info: DataFrame, chunk: Column) -> DataFrame:
    """dws_course_course_subject_category_window."""
    return name_courses(
        windows.trade_by_course(trade_flags(details, chunk, COURSE_COLUMNS)),
        course_info, subject_info, category_info)


def course_steps(course_info: DataFrame, subject_info: DataFrame, category_info: DataFrame
                 ) -> tuple:
    return (
        (course_info, "course_id", {"subject_id": "subject_id"}),
        (subject_info, "subject_id",
         {"subject_name": "subject_name", "category_id": "category_id"}),
        (category_info, "category_id", {"category_name": "category_name"}))


def name_courses(summed: DataFrame, course_info: DataFrame, subject_info: DataFrame,
                 category_info: DataFrame) -> DataFrame:
    return enrich_chain(summed, *course_steps(course_info, subject_info, category_info))


def traffic_marked(page_views: DataFrame, base_source: DataFrame, chunk: Column) -> DataFrame:
    """The traffic window table with the rows to set aside, marked; see :func:`parted`."""
    return enrich_chain_or_mark(
        windows.traffic_by_source_and_visitor(traffic_flags(page_views, chunk)),
        (base_source, "sc", {"source_site": "source_name"}))


def trade_marked(details: DataFrame, base_source: DataFrame, base_province: DataFrame,
                 chunk: Column) -> DataFrame:
    return enrich_chain_or_mark(
        windows.trade_by_source_and_province(trade_flags(details, chunk)),
        *trade_steps(base_source, base_province))


def course_marked(details: DataFrame, course_info: DataFrame, subject_info: DataFrame,
                  category_info: DataFrame, chunk: Column) -> DataFrame:
    return enrich_chain_or_mark(
        windows.trade_by_course(trade_flags(details, chunk, COURSE_COLUMNS)),
        *course_steps(course_info, subject_info, category_info))
