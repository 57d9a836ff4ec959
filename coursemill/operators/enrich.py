"""Dimension lookups as set-based joins.

No broadcast is forced. A dimension below ``spark.sql.autoBroadcastJoinThreshold`` (by its
file size, or by its measured size under AQE) is broadcast; a larger one is joined by
shuffle, where AQE splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _side(dim: DataFrame, dim_key: str, columns: dict[str, str]) -> DataFrame:
    return dim.select(F.col(dim_key).cast("string").alias("_dim_key"),
                      *[F.col(source).alias(name) for source, name in columns.items()])


def _on(key: str) -> Column:
    return F.col(key).cast("string") == F.col("_dim_key")


def enrich(df: DataFrame, dim: DataFrame, key: str, columns: dict[str, str],
           dim_key: str = "id") -> DataFrame:
    """Add ``{dimension column: output column}`` by key. Rows without a dimension row are left out.

    See :func:`without_dimension` for these.
    """
    return df.join(_side(dim, dim_key, columns), _on(key), "inner").drop("_dim_key")


def without_dimension(df: DataFrame, dim: DataFrame, key: str, dim_key: str = "id") -> DataFrame:
    """The rows that :func:`enrich` leaves out."""
    return df.join(_side(dim, dim_key, {}), _on(key), "left_anti")


def enrich_or_mark(df: DataFrame, dim: DataFrame, key: str, columns: dict[str, str],
                   dim_key: str = "id", mark: str = "has_dimension") -> DataFrame:
    """Both kinds of rows in one pass, told apart by ``mark``, for one write of two outputs."""
    return (
        df.join(_side(dim, dim_key, columns), _on(key), "left")
        .withColumn(mark, F.col("_dim_key").isNotNull())
        .drop("_dim_key")
    )


def enrich_chain(df: DataFrame, *steps: tuple[DataFrame, str, dict[str, str]]) -> DataFrame:
    """Follow a snowflake: each step is (dimension, key, columns); later keys may come from
    earlier steps."""
    for dim, key, columns in steps:
        df = enrich(df, dim, key, columns)
    return df


def enrich_chain_or_mark(df: DataFrame, *steps: tuple[DataFrame, str, dict[str, str]],
                         mark: str = "missing") -> DataFrame:
    """The snowflake in one pass for both kinds of rows: ``mark`` names the first key without a
    dimension row, and is NULL where all were found."""
    rows = df.withColumn(mark, F.lit(None).cast("string"))
    for number, (dim, key, columns) in enumerate(steps):
        found = f"_found_{number}"
        rows = enrich_or_mark(rows, dim, key, columns, mark=found).withColumn(
            mark, F.coalesce(mark, F.when(~F.col(found), F.lit(key)))).drop(found)
    return rows


def parted(marked: DataFrame, mark: str = "missing") -> tuple[DataFrame, DataFrame]:
    """Rows with all their dimension rows, and those to set aside with what they lack."""
    return marked.where(F.col(mark).isNull()).drop(mark), marked.where(F.col(mark).isNotNull())
