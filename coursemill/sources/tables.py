"""Table sources: files, partitioned report tables and databases."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill import schemas


def read_jdbc_config(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """The configuration table as it is at start. Connection values come from the caller."""
    return (spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
            .select(*schemas.DIM_CONFIG.names))


def report_day_partition(spark: SparkSession, path: str, day: int = 0,
                         below: str = "") -> DataFrame:
    """One day of a stored report table; the other days' folders are not listed or read.

    ``below`` is the pattern of the folders between the table and its days, such as
    ``run=*/batch_id=*`` for tables that micro-batches write. A day that is not there has no rows.
    """
    from coursemill.operators.reports import one_day, report_day

    compact = report_day(day)
    text = spark.range(1).select(compact).first()[0]
    days = f"cur_date={{{text},{text[:4]}-{text[4:6]}-{text[6:]}}}"
    reader = spark.read.option("basePath", path)
    try:
        rows = reader.parquet("/".join(part for part in (path, below, days) if part))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.read.parquet(path).where("false")
    return one_day(rows.withColumn("cur_date", F.col("cur_date").cast("string")), day)
