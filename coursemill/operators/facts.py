"""The fact tables, each with the declared columns in declared order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill import schemas
from coursemill.functions.scalars import day_text
from coursemill.operators import changelog
from coursemill.operators.asof import enrich_as_of
from coursemill.operators.enrich import enrich, enrich_chain_or_mark
from coursemill.operators.joins import interval_join, spread_join
from coursemill.operators.upsert import latest_per_key

# How far before and after a payment its order rows may lie.
PAY_BEFORE_SECONDS = 15 * 60
PAY_AFTER_SECONDS = 5


def _declared(df: DataFrame, schema) -> DataFrame:
    """Declared columns by name, then arrival order and event time where carried."""
    carried = [n for n in ("arrival", "row_time") if n in df.columns]
    return df.select(*[F.col(n).cast("string").alias(n) for n in schema.names], *carried)


def exam_paper(changes: DataFrame, test_paper: DataFrame) -> DataFrame:
    """Exams with the course of their paper; ``test_paper`` has id and course_id."""
    return _declared(
        enrich(changelog.exams(changes), test_paper, "paper_id", {"course_id": "course_id"}),
        schemas.EXAM_PAPER)


def exam_paper_as_of(changes: DataFrame, versions: DataFrame, arrival: str | Column = "arrival",
                     **options: int) -> DataFrame:
    """Exams with the course that their paper had when they arrived, so a replay sees what the
    first run saw. ``versions`` has id, arrival, alive and course_id."""
    return _declared(
        enrich_as_of(changelog.exams(changes), versions, "paper_id", {"course_id": "course_id"},
                     arrival, **options), schemas.EXAM_PAPER)


def exam_paper_marked(changes: DataFrame, test_paper: DataFrame) -> DataFrame:
    """Exams of all papers; ``missing`` names the key of those whose paper is not known."""
    return enrich_chain_or_mark(
        changelog.exams(changes), (test_paper, "paper_id", {"course_id": "course_id"}))


def review_marked(changes: DataFrame, course_info: DataFrame) -> DataFrame:
    """Reviews of all courses, marked the same way."""
    return enrich_chain_or_mark(
        changelog.reviews(changes), (course_info, "course_id", {"course_name": "course_name"}))


def exam_question(changes: DataFrame) -> DataFrame:
    return _declared(changelog.exam_questions(changes), schemas.EXAM_QUESTION)


def review(changes: DataFrame, course_info: DataFrame) -> DataFrame:
    """Reviews with the name of their course; ``course_info`` has id and course_name."""
    return _declared(
        enrich(changelog.reviews(changes), course_info, "course_id",
               {"course_name": "course_name"}),
        schemas.REVIEW)


def review_as_of(changes: DataFrame, versions: DataFrame, arrival: str | Column = "arrival",
                 **options: int) -> DataFrame:
    """Reviews with the name that their course had when they arrived."""
    return _declared(
        enrich_as_of(changelog.reviews(changes), versions, "course_id",
                     {"course_name": "course_name"}, arrival, **options), schemas.REVIEW)


def cart_add(changes: DataFrame) -> DataFrame:
    return _declared(changelog.cart_adds(changes), schemas.CART_ADD)


def user_register(changes: DataFrame) -> DataFrame:
    return _declared(changelog.registrations(changes), schemas.USER_REGISTER)


def with_day(joined: DataFrame) -> DataFrame:
    """Joined order rows to the declared columns, with the day of their creation."""
    return _declared(
        joined.withColumn("date_id", day_text(F.col("create_time").try_cast("timestamp"))),
        schemas.ORDER_DETAIL)


def order_parts(changes: DataFrame, page_log: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Order lines, headers (``_order_id``) and order-page views (``_sid``), as streams join them."""
    headers = changelog.order_headers(changes).select(
        F.col("id").alias("_order_id"), "session_id", "province_id")
    views = changelog.order_page_sources(page_log).select(
        F.col("sid").alias("_sid"), F.col("sc").alias("source"))
    return changelog.order_lines(changes), headers, views


def order_detail(changes: DataFrame, page_log: DataFrame, sessions: str = "latest") -> DataFrame:
    """Order lines with the header's session and province and the session's source.

    ``sessions="latest"`` takes the last order-page view of a session, which is what remains
    in the keyed table; ``"all"`` gives one row per view, as in the appended log.
    """
    lines = changelog.order_lines(changes)
    headers = changelog.order_headers(changes).select(
        F.col("id").alias("order_id"), "session_id", "province_id")
    views = changelog.order_page_sources(page_log).select(
        F.col("sid").alias("session_id"), F.col("sc").alias("source"),
        F.col("arrival").alias("_view"))
    # Headers meet their session first: they are fewer and narrower than lines, which then
    # are shuffled once, by order.
    if sessions == "latest":
        headers = spread_join(headers, latest_per_key(views, "session_id", "_view").drop("_view"),
                              "session_id", spread_by="order_id")
    elif sessions == "all":
        headers = headers.join(views.drop("_view"), "session_id")
    else:
        raise ValueError("sessions is 'latest' or 'all'")
    joined = lines.join(headers, "order_id")
    return with_day(joined)


def payment_success(changes: DataFrame, details: DataFrame,
                    before_seconds: int = PAY_BEFORE_SECONDS,
                    after_seconds: int = PAY_AFTER_SECONDS) -> DataFrame:
    """Paid payments with their order rows, one row per order row. ``ts`` is the order row's.

    Both inputs carry ``row_time``. :func:`latest_per_key` on id gives the table keyed by
    payment, which keeps one order row per payment.
    """
    paid = changelog.payments(changes).select(
        "id", "order_id", "total_amount", F.col("row_time").alias("_pay_time"))
    rows = details.select(
        F.col("id").alias("detail_id"), "order_id", "ts", "user_id", "course_id", "course_name",
        "origin_amount", "coupon_reduce", "final_amount", "session_id", "province_id",
        F.col("row_time"), *[c for c in ("arrival",) if c in details.columns])
    return _declared(
        interval_join(paid, rows, ["order_id"], "_pay_time", "row_time",
                      before_seconds, after_seconds),
        schemas.PAYMENT_SUCCESS)
