"""Change log and fact projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill.functions.scalars import seconds_to_time

# Markers around an initial load, and the code of a paid payment.
LOAD_MARKERS = ("bootstrap-start", "bootstrap-complete")
PAID = "1602"


def without_load_markers(changes: DataFrame) -> DataFrame:
    """Drop the records that only mark an initial load. A record without a type is kept."""
    kind = F.col("type")
    return changes.where(kind.isNull() | ~kind.isin(*LOAD_MARKERS))


def inserts_of(changes: DataFrame, table: str) -> DataFrame:
    """Insert records of one source table; initial-load rows and updates are not inserts."""
    return changes.where((F.col("table") == table) & (F.col("type") == "insert"))


def _carried(df: DataFrame, *names: str) -> list[Column]:
    """Columns passed through where present: arrival order and event time."""
    return [F.col(n) for n in names if n in df.columns]


def _data(changes: DataFrame, names: str, *more: str) -> DataFrame:
    return changes.select(
        *[F.col("data")[name].alias(name) for name in names.split()],
        *more, *_carried(changes, "arrival", "row_time"))


def with_row_time(changes: DataFrame) -> DataFrame:
    """Event time from the change-log seconds."""
    return changes.withColumn("row_time", seconds_to_time(F.col("ts")))


def exams(changes: DataFrame) -> DataFrame:
    return _data(inserts_of(changes, "test_exam"),
                 "id paper_id user_id score duration_sec create_time")


def exam_questions(changes: DataFrame) -> DataFrame:
    return _data(inserts_of(changes, "test_exam_question"),
                 "id exam_id paper_id question_id user_id is_correct")


def reviews(changes: DataFrame) -> DataFrame:
    return _data(inserts_of(changes, "review_info"), "id user_id course_id review_stars", "ts")


def cart_adds(changes: DataFrame) -> DataFrame:
    return _data(inserts_of(changes, "cart_info"),
                 "id user_id course_id course_name cart_price session_id", "ts")


def order_lines(changes: DataFrame) -> DataFrame:
    return _data(
        inserts_of(changes, "order_detail"),
        "id course_id course_name order_id user_id origin_amount coupon_reduce final_amount "
        "create_time", "ts")


def order_headers(changes: DataFrame) -> DataFrame:
    return _data(
        inserts_of(changes, "order_info"),
        "id user_id origin_amount coupon_reduce final_amount order_status session_id province_id",
        "ts")


def payments(changes: DataFrame) -> DataFrame:
    """Paid payments only."""
    paid = inserts_of(changes, "payment_info").where(F.col("data")["payment_status"] == PAID)
    return _data(paid, "id order_id total_amount", "ts")


def registrations(changes: DataFrame) -> DataFrame:
    return _data(inserts_of(changes, "user_info"), "id login_name user_level create_time", "ts")


def order_page_sources(page_log: DataFrame) -> DataFrame:
    """Session and source of each view of the order page."""
    common = F.col("common")
    return (page_log.where(F.col("page")["page_id"] == "order")
            .select(common["sc"].alias("sc"), common["sid"].alias("sid"),
                    *_carried(page_log, "arrival", "row_time")))
