"""The warehouse jobs on streams. Window names are looked up per micro-batch, in the sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.operators import changelog, facts, logsplit, windows
from coursemill.plans import jobs
from coursemill.streaming import state

# How long order facts wait for each other, and the SQL jobs' disorder.
ORDER_BAND = "5 seconds"
NO_DISORDER = "0 seconds"


def split_log(log: DataFrame) -> DataFrame:
    """Log text (value, arrival) to (topic, value) rows, dirty rows included."""
    parsed = logsplit.parse_log(log)
    repaired = state.repair_new_visitor(logsplit.usable(parsed))
    return logsplit.split(repaired).unionByName(logsplit.dirty(parsed))


def traffic_rows(page_views: DataFrame, idle_ms: int | None = state.ONE_DAY_MS) -> DataFrame:
    """Flagged rows, to be summed per micro-batch; see :func:`sinks.window_parts_writer`."""
    return windows.traffic_measures(
        state.visit_flags(page_views.select(*jobs.TRAFFIC_COLUMNS), idle_ms=idle_ms))


def trade_rows(details: DataFrame, order: Sequence[str] = ("arrival",),
               idle_ms: int | None = state.ONE_DAY_MS) -> DataFrame:
    """Order rows with flag and measures, to be summed per micro-batch."""
    columns = [c for c in jobs.TRADE_COLUMNS if c != "arrival"]
    return _measured(details, columns, order, idle_ms)


def traffic_windows(page_views: DataFrame, disorder: str = windows.DISORDER,
                    idle_ms: int | None = state.ONE_DAY_MS) -> DataFrame:
    # The watermark is set after the keyed state, which does not pass one on.
    return windows.traffic_by_source_and_visitor(
        traffic_rows(page_views, idle_ms).withWatermark("row_time", disorder))


def traffic_windows_of_flags(flagged: DataFrame, disorder: str = windows.DISORDER) -> DataFrame:
    """The same over rows that a job before has flagged (:func:`carried.visit_flags_writer`)."""
    return windows.traffic_by_source_and_visitor(
        windows.traffic_measures(flagged).withWatermark("row_time", disorder))


def trade_windows_of_flags(flagged: DataFrame, disorder: str = windows.DISORDER) -> DataFrame:
    """Trade windows of rows that :func:`carried.first_order_writer` has flagged."""
    return windows.trade_by_source_and_province(
        windows.trade_measures(flagged).withWatermark("row_time", disorder))


def keyword_windows(page_log: DataFrame, disorder: str = NO_DISORDER) -> DataFrame:
    return windows.keyword_counts(
        windows.searches(page_log).withWatermark("row_time", disorder))


def _measured(details: DataFrame, columns: Sequence[str], order: Sequence[str],
              idle_ms: int | None) -> DataFrame:
    rows = jobs.order_rows(details).select(*dict.fromkeys([*columns, "order_date", *order]))
    return windows.trade_measures(
        state.daily_first_order_flag(rows, order=order, idle_ms=idle_ms))


def _trade_flags(details: DataFrame, columns: Sequence[str], order: Sequence[str],
                 disorder: str, idle_ms: int | None) -> DataFrame:
    return _measured(details, columns, order, idle_ms).withWatermark("row_time", disorder)


def trade_windows(details: DataFrame, order: Sequence[str] = ("arrival",),
                  disorder: str = windows.DISORDER,
                  idle_ms: int | None = state.ONE_DAY_MS) -> DataFrame:
    columns = [c for c in jobs.TRADE_COLUMNS if c != "arrival"]
    return windows.trade_by_source_and_province(_trade_flags(
        details, columns, order, disorder, idle_ms))


def course_windows(details: DataFrame, order: Sequence[str] = ("arrival",),
                   disorder: str = windows.DISORDER,
                  idle_ms: int | None = state.ONE_DAY_MS) -> DataFrame:
    columns = [c for c in jobs.COURSE_COLUMNS if c != "arrival"]
    flagged = _trade_flags(details, columns, order, disorder, idle_ms)
    if list(order) != ["arrival"]:
        flagged = flagged.withColumn("arrival", F.struct(*order))
    return windows.trade_by_course(flagged)


def chapter_windows(plays: DataFrame, disorder: str = windows.DISORDER) -> DataFrame:
    """Plays per chapter and window. Rows carry ``row_time``; those without one are left out."""
    return windows.plays_by_chapter(
        plays.where(F.col("row_time").isNotNull()).withWatermark("row_time", disorder))


def order_detail(changes: DataFrame, page_log: DataFrame, band: str = ORDER_BAND,
                 disorder: str = windows.DISORDER) -> DataFrame:
    """Order lines, their header and the session's order-page views, at most ``band`` apart.

    One row comes out per view, as an appended log; :func:`latest_per_key` on id keeps one.
    The band is in event time, so the result does not depend on when rows happen to arrive.
    Inputs carry ``row_time``.
    """
    wait = F.expr(f"INTERVAL {band}")

    def near(left: str, right: str):
        return (F.col(right) >= F.col(left) - wait) & (F.col(right) <= F.col(left) + wait)

    lines = changelog.order_lines(changes).withWatermark("row_time", disorder)
    headers = changelog.order_headers(changes).select(
        F.col("id").alias("_order_id"), F.col("session_id"), "province_id",
        F.col("row_time").alias("_header_time")).withWatermark("_header_time", disorder)
    views = changelog.order_page_sources(page_log).select(
        F.col("sid").alias("_sid"), F.col("sc").alias("source"),
        F.col("row_time").alias("_view_time")).withWatermark("_view_time", disorder)
    joined = lines.join(
        headers, (F.col("order_id") == F.col("_order_id")) & near("row_time", "_header_time")
    ).join(views, (F.col("session_id") == F.col("_sid")) & near("row_time", "_view_time"))
    return facts.with_day(joined)


def payment_success(changes: DataFrame, details: DataFrame, disorder: str = NO_DISORDER,
                    **bounds: int) -> DataFrame:
    """Interval join of two streams; both carry ``row_time``."""
    return facts.payment_success(changes.withWatermark("row_time", disorder),
                                 details.withWatermark("row_time", disorder), **bounds)
