"""Column expressions and reading shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of bytes that are neither a space nor one of tab, line feed, vertical
# tab, form feed, carriage return. Python's bytes.split() cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words, 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def aside(docs: DataFrame, *taken: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The rows with columns of taken names renamed, and what gives them their names back."""
    held, names = {}, {c.lower() for c in docs.columns} | set(taken)
    for name in docs.columns:
        if name.lower() in taken:
            other = f"{name}_"
            while other.lower() in names:
                other += "_"
            names.add(other.lower())
            held[name] = other
    back = {other: name for name, other in held.items()}
    return docs.withColumnsRenamed(held), lambda rows: rows.withColumnsRenamed(back)
