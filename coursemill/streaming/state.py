"""Streaming forms of the per-key memory: one small state row per key.

Analytic windows are refused on streams, so these use keyed state. What the functions hold of
a key in a micro-batch is bounded by the source's rows per trigger, because rows of a group
come unordered and are put in arrival order first. Results equal those of
:mod:`coursemill.operators.state` on the same rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from coursemill.functions.scalars import day_text, is_blank

# The functions below travel to the workers by value, so that the package need not be installed
# on every machine.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: idle state of the daily flags is kept for a day.
ONE_DAY_MS = 24 * 60 * 60 * 1000


def _keyed(df: DataFrame, key: str, fn: Callable, out: StructType, state: str,
           idle_ms: int | None) -> DataFrame:
    # With a processing-time timeout Spark always has another batch to run, so a query over
    # what is there now would never end. Such a run takes idle_ms=None.
    timeout = (GroupStateTimeout.ProcessingTimeTimeout if idle_ms
               else GroupStateTimeout.NoTimeout)
    return df.groupBy(key).applyInPandasWithState(fn, out, state, "append", timeout)


def _in_order(frames, order: Sequence[str]) -> pd.DataFrame:
    return pd.concat(list(frames), ignore_index=True).sort_values(
        list(order), kind="stable", ignore_index=True)


def _before(values: pd.Series, first) -> pd.Series:
    """Each row's value in the row before; ``first`` comes from the state."""
    previous = values.astype(object).shift(1)
    previous.iloc[0] = first
    return previous


def visit_flags(df: DataFrame, key: str = "mid", order: Sequence[str] = ("arrival",),
                idle_ms: int | None = ONE_DAY_MS) -> DataFrame:
    """Streaming form of :func:`coursemill.operators.state.visit_flags`.

    After an idle day the last day is of no more use, but a session start still is: the next
    row may show that the session went on. So only keys without one are forgotten.
    """
    rows = df.withColumns({
        "_day": day_text(F.col("visit_date")), "_starts": is_blank(F.col("last_page_id"))})
    names = ("uv_ct", "sv_ct", "so_ct")
    out = StructType([*df.schema.fields, *[StructField(n, LongType()) for n in names]])

    def flags(_, frames, state: GroupState):
        day, starts = state.get if state.exists else (None, None)
        if state.hasTimedOut:
            if not starts:
                state.remove()
            return
        rows = _in_order(frames, order)
        now = rows["_starts"].astype(bool)
        went_on = _before(now, starts).eq(True)
        rows["uv_ct"] = rows["_day"].ne(_before(rows["_day"], day)).astype("int64")
        rows["sv_ct"] = now.astype("int64")
        rows["so_ct"] = now.astype("int64") - (~now & went_on).astype("int64")
        state.update((rows["_day"].iloc[-1], bool(now.iloc[-1])))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield rows[out.names]

    return _keyed(rows, key, flags, out, "day string, starts boolean", idle_ms)


def daily_first_order_flag(df: DataFrame, key: str = "user_id",
                           order: Sequence[str] = ("arrival",),
                           idle_ms: int | None = ONE_DAY_MS) -> DataFrame:
    """Streaming form of :func:`coursemill.operators.state.daily_first_order_flag`."""
    rows = df.withColumn("_day", day_text(F.col("order_date")))
    out = StructType([*df.schema.fields, StructField("order_user_ct", LongType())])

    def flags(_, frames, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        day = state.get[0] if state.exists else None
        rows = _in_order(frames, order)
        rows["order_user_ct"] = rows["_day"].ne(_before(rows["_day"], day)).astype("int64")
        state.update((rows["_day"].iloc[-1],))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield rows[out.names]

    return _keyed(rows, key, flags, out, "day string", idle_ms)


def repair_new_visitor(df: DataFrame, key: str = "mid", order: Sequence[str] = ("arrival",)
                       ) -> DataFrame:
    """Streaming form of :func:`coursemill.operators.state.repair_new_visitor`; kept for good."""
    says_new = F.col("is_new") == "1"
    rows = df.withColumns({
        "_day": day_text(F.col("visit_date")),
        "_known_since": day_text(F.when(says_new, F.col("visit_date")).otherwise(
            F.date_sub("visit_date", 1)))})
    out = StructType(df.schema.fields)

    def repaired(_, frames, state: GroupState):
        rows = _in_order(frames, order)
        if not state.exists:
            state.update((rows["_known_since"].iloc[0],))
        first_day = state.get[0]
        rows.loc[rows["is_new"].eq("1") & rows["_day"].ne(first_day), "is_new"] = "0"
        yield rows[out.names]

    return _keyed(rows, key, repaired, out, "first_day string", None)
