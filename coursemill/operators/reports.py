"""Daily reports over the window tables, with ties broken by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill.functions.scalars import compact_day_text
from coursemill.schemas import MONEY

# Fixed value: rows of a top-k report when the caller names no number.
TOP = 10


def report_day(day: int = 0) -> Column:
    """The asked day as yyyyMMdd text; 0 stands for today."""
    return F.lit(str(day)) if day else compact_day_text(F.current_date())


def one_day(report: DataFrame, day: int = 0, column: str = "cur_date") -> DataFrame:
    """One day of a report table; reads only that day's partition.

    The window tables keep ``cur_date`` as a DATE-like text with or without dashes, so the
    asked day is brought to the table's form instead of changing the partition column.
    """
    compact = report_day(day)
    dashed = F.concat_ws("-", F.substring(compact, 1, 4), F.substring(compact, 5, 2),
                         F.substring(compact, 7, 2))
    return report.where(F.col(column).isin(compact, dashed))


def _top(df: DataFrame, measure: str, name: str, k: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(measure), F.asc(name)).limit(k)


def amount_by_source(trade: DataFrame, k: int = TOP) -> DataFrame:
    sums = (trade.groupBy(F.col("source_name").alias("sc"))
            .agg(F.sum("order_amount").alias("amount")))
    return _top(sums, "amount", "sc", k)


def orders_by_source(trade: DataFrame, k: int = TOP) -> DataFrame:
    sums = (trade.groupBy(F.col("source_name").alias("sc"))
            .agg(F.sum("order_ct").alias("ordered")))
    return _top(sums, "ordered", "sc", k)


def conversion_by_source(trade: DataFrame, k: int = TOP) -> DataFrame:
    """The conversion report has no formula of its own: it shows the orders by source."""
    return orders_by_source(trade, k)


def trade_by_province(trade: DataFrame) -> DataFrame:
    return trade.groupBy("province_name").agg(
        F.sum("order_amount").alias("order_amount"),
        F.sum("order_user_ct").alias("order_user_ct"),
        F.sum("order_ct").alias("order_ct"))


def visitors_by_source(traffic: DataFrame, k: int = TOP) -> DataFrame:
    sums = traffic.groupBy("source_name").agg(
        F.sum(F.col("uv_ct").try_cast("int")).alias("uv"))
    return _top(sums, "uv", "source_name", k)


def bounce_rate_by_source(traffic: DataFrame, k: int = TOP) -> DataFrame:
    """Bounced sessions per session; 0.00 where there are no sessions."""
    rate = F.coalesce(F.try_divide(F.sum("so_ct"), F.sum("sv_ct")), F.lit(0.0))
    return _top(
        traffic.groupBy("source_name").agg(rate.cast(MONEY).alias("jump_out")),
        "jump_out", "source_name", k)
