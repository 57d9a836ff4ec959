"""Small column functions shared by the jobs. All are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text renderings of days and times.
DAY = "yyyy-MM-dd"
SECOND = "yyyy-MM-dd HH:mm:ss"
COMPACT_DAY = "yyyyMMdd"


def seconds_to_time(seconds: Column) -> Column:
    """Change-log time: seconds since the epoch, as text or number."""
    return F.timestamp_seconds(seconds.try_cast("bigint"))


def millis_to_time(millis: Column) -> Column:
    """Behaviour-log time: milliseconds since the epoch."""
    return F.timestamp_millis(millis.try_cast("bigint"))


def millis_to_whole_second(millis: Column) -> Column:
    """Like :func:`millis_to_time`, with the milliseconds cut off."""
    return F.date_trunc("second", millis_to_time(millis))


def day_text(time: Column) -> Column:
    return F.date_format(time, DAY)


def second_text(time: Column) -> Column:
    return F.date_format(time, SECOND)


def compact_day_text(time: Column) -> Column:
    return F.date_format(time, COMPACT_DAY)


def text_to_millis(text: Column, with_time: bool = False) -> Column:
    """Day text, or day and time text, to milliseconds; NULL where it does not parse."""
    return F.unix_millis(F.try_to_timestamp(text, F.lit(SECOND if with_time else DAY)))


def processing_time() -> Column:
    """When a row is handled: the start of its query, or of its micro-batch on a stream."""
    return F.current_timestamp()


def is_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def differs(left: Column, right: Column) -> Column:
    """IS DISTINCT FROM."""
    return ~left.eqNullSafe(right)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
