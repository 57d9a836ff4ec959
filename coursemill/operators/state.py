"""Per-key memory of the row before, on whole tables.

The jobs here look at a key's previous (or first) row in arrival order. A plain
``Window.partitionBy(key)`` puts all rows of a key into one task, which fails when one
device or user holds a large part of the data. So the rows per key are counted, and the arrival
order of the keys with over ``hot_rows`` rows is cut into chunks:

1. each (hot key, chunk) is reduced to its last value, with map-side combining;
2. these few values are ordered per key, which says what each chunk starts from;
3. all rows are sorted per (key, chunk), a chunk starting from the value that enters it. A
   key that is not hot is one chunk.

The result is exact for every chunk size and every ``hot_rows``. Which keys are hot is stored
before it is used: all places must see one list.
NULL is a key like any other. A task holds at most a chunk
of a hot key, or ``hot_rows`` rows of another. The data is shuffled once; the counts, and the
last values of hot keys, read few columns. So the input should be a scan; what comes out of
a join should be stored first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursemill import session
from coursemill.functions.scalars import differs, flag, is_blank
from coursemill.operators.joins import HOT_ROWS, hot_keys, hottest, to_join

CHUNK = 1 << 20


def chunk_of(number: str | Column, span: int = CHUNK) -> Column:
    """The chunk of an arrival number, as its first number: it never falls as numbers rise."""
    number = (F.col(number) if isinstance(number, str) else number).cast("bigint")
    return number - F.pmod(number, F.lit(span))


def with_previous(df: DataFrame, key: str, arrival: str, values: dict[str, Column],
                  chunk: Column, out: str = "previous", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add struct ``out``: ``values`` as they were in the key's previous row.

    ``chunk`` is a number that does not fall as ``arrival`` rises. ``out`` is NULL in a key's
    first row.
    """
    held = [f"_v_{name}" for name in values]
    rows = df.withColumns({
        **{f"_v_{name}": value for name, value in values.items()},
        "_chunk": chunk,
    })
    hot = to_join(hot_keys(df, key, hot_rows).withColumnRenamed(key, "_hot_key"))
    same = F.col(key).eqNullSafe(F.col("_hot_key"))
    tails = (rows.join(hot, same).groupBy(key, "_chunk")
             .agg(*[F.max_by(c, arrival).alias(c) for c in held]))
    # The last values of a chunk enter the key's next chunk as a row ahead of all others.
    # Sent as rows, they need no join and no second shuffle of the data.
    entering = (
        tails.withColumn("_chunk", F.lead("_chunk").over(
            Window.partitionBy(key).orderBy("_chunk")))
        .where(F.col("_chunk").isNotNull())
        .withColumn("_is_row", F.lit(False))
    )
    placed = (rows.join(hot, same, "left")
              .withColumn("_chunk", F.when(F.col("_hot"), F.col("_chunk"))).drop("_hot", "_hot_key")
              .withColumn("_is_row", F.lit(True)))
    in_chunk = Window.partitionBy(key, "_chunk").orderBy("_is_row", arrival)
    return (
        placed.unionByName(entering, allowMissingColumns=True)
        .withColumn(out, F.lag(F.struct(
            *[F.col(f"_v_{name}").alias(name) for name in values])).over(in_chunk))
        .where("_is_row")
        .drop("_is_row", "_chunk", *held)
    )


def with_first(df: DataFrame, key: str, arrival: str, value: Column, out: str,
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``out``: ``value`` as it was in the key's first row. NULL is a key like any other.

    The rows of hot keys get it from a list, broadcast up to HOT_KEYS keys, and take no part in
    the join that serves the other rows. One aggregate, stored, gives both the first values and
    the counts.
    """
    heads = session.stored(df.withColumn(out, value).groupBy(F.col(key).alias("_head_key")).agg(
        F.min_by(out, arrival).alias(out), F.count("*").alias("_rows")), "heads")
    hot = to_join(
        hottest(heads, hot_rows).select(F.col("_head_key").alias("_hot_key"),
                                        F.struct(out).alias("_hot")))
    cold = heads.select("_head_key", F.struct(out).alias("_cold"))
    marked = df.join(hot, F.col(key).eqNullSafe(F.col("_hot_key")), "left").drop("_hot_key")
    served = marked.where("_hot IS NULL").join(
        cold, F.col(key).eqNullSafe(F.col("_head_key")), "left").withColumn(
        out, F.col("_cold")[out]).drop("_hot", "_head_key", "_cold")
    return marked.where("_hot IS NOT NULL").withColumn(out, F.col("_hot")[out]).drop(
        "_hot").unionByName(served)


def repair_new_visitor(df: DataFrame, key: str = "mid", arrival: str = "arrival",
                       day: str = "visit_date", is_new: str = "is_new",
                       hot_rows: int = HOT_ROWS) -> DataFrame:
    """Correct the new-visitor flag: a device is new only on the day it was first seen.

    A device first seen with flag 0 was known before, so its first day is the day before.
    """
    says_new = F.col(is_new) == "1"
    known_since = F.when(says_new, F.col(day)).otherwise(F.date_sub(F.col(day), 1))
    seen = with_first(df, key, arrival, known_since, "_first_day", hot_rows)
    return seen.withColumn(
        is_new,
        F.when(says_new & (F.col("_first_day") != F.col(day)), F.lit("0")).otherwise(F.col(is_new)),
    ).drop("_first_day")


def new_day_flag(day: Column, previous_day: Column) -> Column:
    """1 where the day is another one than in the key's previous row.

    A late row of an older day counts again, and so does the row after it.
    """
    return flag(differs(previous_day, day))


def starts_session(last_page_id: Column) -> Column:
    return is_blank(last_page_id)


def bounce_flag(starts: Column, previous_starts: Column) -> Column:
    """+1 for a session start; -1 for the row that shows the session went on."""
    return (F.when(starts, F.lit(1)).when(previous_starts, F.lit(-1)).otherwise(F.lit(0))
            .cast("bigint"))


def visit_flags(df: DataFrame, chunk: Column, key: str = "mid", arrival: str = "arrival",
                day: str = "visit_date", last_page_id: str = "last_page_id",
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add daily unique visitor, session and bounce flags: uv_ct, sv_ct, so_ct."""
    starts = starts_session(F.col(last_page_id))
    seen = with_previous(df, key, arrival, {"day": F.col(day), "starts": starts}, chunk,
                         hot_rows=hot_rows)
    return seen.withColumns({
        "uv_ct": new_day_flag(F.col(day), F.col("previous.day")),
        "sv_ct": flag(starts),
        "so_ct": bounce_flag(starts, F.col("previous.starts")),
    }).drop("previous")


def daily_first_order_flag(df: DataFrame, chunk: Column, key: str = "user_id",
                           arrival: str = "arrival", day: str = "order_date",
                           hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add order_user_ct: 1 for the first order row of a user on a day."""
    seen = with_previous(df, key, arrival, {"day": F.col(day)}, chunk, hot_rows=hot_rows)
    return seen.withColumn(
        "order_user_ct", new_day_flag(F.col(day), F.col("previous.day"))).drop("previous")
