"""Keyed tables kept as appended rows: the last row per key wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | Sequence[str], arrival: str = "arrival") -> DataFrame:
    """The last row of each key by arrival.

    Spark turns ``row_number() = 1`` into a group limit that runs ahead of the shuffle, so each
    map task sends one row per key, however many rows a key has.
    """
    keys = [key] if isinstance(key, str) else list(key)
    newest = Window.partitionBy(*keys).orderBy(F.desc(arrival))
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
