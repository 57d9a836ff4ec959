"""Joins between facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill import session

# A key with more rows than this is spread over SALTS tasks.
HOT_ROWS = 1_000_000
# A list of at most so many hot keys is broadcast.
HOT_KEYS = 10_000
SALTS = 64


def hottest(counted: DataFrame, hot_rows: int) -> DataFrame:
    """The rows of a table with ``_rows`` per key that are over ``hot_rows``, as a stored table.

    It is stored because several places of a job ask which keys are hot, and all need one answer.
    """
    return session.stored(counted.where(F.col("_rows") > hot_rows), "hot")


def to_join(hot: DataFrame) -> DataFrame:
    """A stored list of hot keys, to be broadcast if it has at most HOT_KEYS rows."""
    return F.broadcast(hot) if hot.limit(HOT_KEYS + 1).count() <= HOT_KEYS else hot


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All keys with over ``hot_rows`` rows, marked ``_hot``, as a stored table. Counting combines
    on the map side."""
    counted = df.groupBy(key).agg(F.count("*").alias("_rows"))
    return hottest(counted, hot_rows).select(key, F.lit(True).alias("_hot"))


def spread_join(facts: DataFrame, other: DataFrame, on: str, spread_by: str,
                hot_rows: int = HOT_ROWS, salts: int = SALTS) -> DataFrame:
    """Inner join of a large side with one that has few rows per key, safe for hot keys.

    AQE cannot split a skewed partition when the other side comes straight from an
    aggregation, as "the last row per session" does. So keys with over ``hot_rows`` rows are
    found by a counting aggregate, their rows are spread by a hash of ``spread_by``, and only
    their partners are repeated. The list of them is broadcast up to HOT_KEYS keys, else shuffled.
    """
    hot = to_join(hot_keys(facts, on, hot_rows))

    def marked(df: DataFrame) -> DataFrame:
        return df.join(hot, on, "left")

    salted = marked(facts).withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
        .otherwise(F.lit(0))).drop("_hot")
    repeated = marked(other).withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                           .otherwise(F.array(F.lit(0))))).drop("_hot")
    return salted.join(repeated, [on, "_salt"], "inner").drop("_salt")


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str,
                  right_time: str, before_seconds: int, after_seconds: int) -> DataFrame:
    """Pairs with equal keys and right time in [left - before, left + after], both ends included.

    Time is cut into pieces as long as the interval, so a left row meets the right rows of
    the two or three pieces that its interval touches, not all rows of its key. The
    columns of the two sides must have different names, apart from ``on``. On streams both
    sides need a watermark; the plain time condition lets Spark drop old state.
    """
    piece = max(before_seconds + after_seconds, 1)

    def piece_of(second):
        return F.floor(second / F.lit(piece))

    # Whole seconds, rounded outwards, only choose the pieces; the exact test follows.
    second = F.unix_seconds(left_time)
    pieces = F.sequence(piece_of(second - F.lit(before_seconds)),
                        piece_of(second + F.lit(after_seconds + 1)))
    spread = left.withColumn("_piece", F.explode(pieces))
    placed = right.withColumn("_right_piece", piece_of(F.unix_seconds(right_time)))
    for name in on:
        placed = placed.withColumnRenamed(name, f"_right_{name}")
    keys = [F.col(name) == F.col(f"_right_{name}") for name in on]
    return spread.join(
        placed,
        [*keys, F.col("_piece") == F.col("_right_piece"),
         F.col(right_time) >= F.col(left_time) - F.make_dt_interval(secs=F.lit(before_seconds)),
         F.col(right_time) <= F.col(left_time) + F.make_dt_interval(secs=F.lit(after_seconds))],
        "inner",
    ).drop("_piece", "_right_piece", *[f"_right_{name}" for name in on])
