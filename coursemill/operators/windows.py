"""Ten-second event-time windows. Each function takes a table or a stream.

On a stream the input must carry a watermark on its time column. Sums combine on the map
side, so a window key with very many rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill.functions.scalars import compact_day_text, day_text, second_text
from coursemill.schemas import MONEY

# Window length and the disorder that the window jobs wait for.
WINDOW = "10 seconds"
DISORDER = "2 seconds"

TRAFFIC_SUMS = ("uv_ct", "sv_ct", "so_ct", "pv_ct", "dur_sum")


def _stamped(windowed: DataFrame, render_day=day_text) -> DataFrame:
    """Replace the window by its texts: start, end and day of the start."""
    return windowed.withColumns({
        "stt": second_text(F.col("window.start")),
        "edt": second_text(F.col("window.end")),
        "cur_date": render_day(F.col("window.start")),
    }).drop("window")


def traffic_measures(df: DataFrame) -> DataFrame:
    """One page view per row, and its stay time in ms."""
    return df.withColumns({
        "pv_ct": F.lit(1).cast("bigint"),
        "dur_sum": F.col("during_time").cast("bigint"),
    })


def traffic_by_source_and_visitor(df: DataFrame, time: str = "row_time") -> DataFrame:
    """(source, new/old visitor) per window: visitors, sessions, bounces, views, stay time."""
    return _stamped(
        df.groupBy(F.window(time, WINDOW), "sc", "is_new")
        .agg(*[F.sum(name).alias(name) for name in TRAFFIC_SUMS]))


def searches(page_log: DataFrame) -> DataFrame:
    """Search rows of the page log: the searched words with the row's time."""
    page = F.col("page")
    return (page_log.where(page["item"].isNotNull() & (page["item_type"] == "keyword"))
            .select(page["item"].alias("keyword"), "row_time"))


def keyword_counts(df: DataFrame, time: str = "row_time") -> DataFrame:
    """Searches per keyword and window."""
    return _stamped(
        df.groupBy(F.window(time, WINDOW), "keyword")
        .agg(F.count("*").alias("keyword_count")), compact_day_text)


def trade_measures(details: DataFrame) -> DataFrame:
    """One order row, and its amount. Text that is no number counts as no amount."""
    return details.withColumns({
        "order_ct": F.lit(1).cast("bigint"),
        "order_amount": F.col("final_amount").try_cast(MONEY),
    })


def _trade_sums() -> list[Column]:
    return [F.sum("order_ct").alias("order_ct"),
            F.sum("order_user_ct").alias("order_user_ct"),
            F.sum("order_amount").alias("order_amount")]


def trade_by_source_and_province(df: DataFrame, time: str = "row_time") -> DataFrame:
    """(source, province) per window: orders, first orders of the day, amount."""
    return _stamped(
        df.groupBy(F.window(time, WINDOW), "sc", "province_id").agg(*_trade_sums()))


def trade_by_course(df: DataFrame, time: str = "row_time", arrival: str = "arrival") -> DataFrame:
    """(course) per window. The name is the one of the window's first row.

    Subject and category are looked up from the course afterwards: they depend on it alone,
    so the sums are the same and the lookups see one row per window and course.
    """
    return _stamped(
        df.groupBy(F.window(time, WINDOW), "course_id")
        .agg(F.min_by("course_name", arrival).alias("course_name"), *_trade_sums()))


def plays_by_chapter(df: DataFrame, time: str = "row_time") -> DataFrame:
    """(chapter) per window: plays, play seconds, users. An extra built on declared names only."""
    return _stamped(
        df.groupBy(F.window(time, WINDOW), "chapter_id")
        .agg(F.sum("play_count").alias("play_count"), F.sum("play_sec").alias("play_sec"),
             F.sum("play_user").alias("play_user")))
