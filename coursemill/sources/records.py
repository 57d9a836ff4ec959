"""Text records to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from coursemill import schemas
from coursemill.functions.scalars import (
    millis_to_whole_second,
    processing_time,
    seconds_to_time,
)

_BAD = "_bad"


def records(topic: DataFrame, schema: StructType, carry: tuple[str, ...] = ("arrival",)
            ) -> DataFrame:
    """JSON text in ``value`` to declared columns. Null messages and bad text are left out.

    See :func:`bad_records` for the text. Each text is either a record or bad, as a whole.
    """
    parsed = _parsed(topic, schema).where(~F.col(_BAD))
    return parsed.select(*[F.col("r")[n].alias(n) for n in schema.names],
                         *[c for c in carry if c in topic.columns])


def bad_records(topic: DataFrame, schema: StructType) -> DataFrame:
    """Text that is no record of the schema, for the dirty output; null messages are not."""
    return _parsed(topic, schema).where(F.col(_BAD) & F.col("value").isNotNull()).select(
        "value", *[c for c in ("arrival",) if c in topic.columns])


def _parsed(topic: DataFrame, schema: StructType) -> DataFrame:
    # One parse says both what a record holds and whether the whole text is one: it is read as the
    # only element of an array in an object, so text behind the record breaks the object. Text
    # that does not parse or fit the schema shows as the kept text.
    # Exploding makes what was parsed a column of its own, so a filter on it does not parse again.
    kept = StructType([StructField("one", ArrayType(schema)),
                       StructField("_corrupt", StringType())])
    text = F.concat(F.lit('{"one":['), F.col("value"), F.lit("]}"))
    parsed = topic.withColumn("p", F.explode(F.array(F.from_json(
        text, kept, {"columnNameOfCorruptRecord": "_corrupt"}))))
    good = (F.col("p._corrupt").isNull() & (F.size("p.one") == 1)
            & F.get("p.one", F.lit(0)).isNotNull() & F.rtrim("value").endswith("}"))
    return parsed.select(*topic.columns, F.get("p.one", F.lit(0)).alias("r"),
                         (~F.coalesce(good, F.lit(False))).alias(_BAD))


def change_log_records(topic: DataFrame, with_proc_time: bool = False) -> DataFrame:
    """Change log with event time, and with ``proc_time``, when it is handled, if asked for."""
    rows = records(topic, schemas.CHANGE_LOG)
    rows = rows.withColumn("row_time", seconds_to_time(F.col("ts")))
    return rows.withColumn("proc_time", processing_time()) if with_proc_time else rows


def page_log_records(topic: DataFrame) -> DataFrame:
    """Page log as maps, with event time cut to the second."""
    rows = records(topic, schemas.PAGE_LOG)
    rows = rows.withColumn("ts", F.col("ts").try_cast("bigint"))
    return rows.withColumn("row_time", millis_to_whole_second(F.col("ts")))


def config_records(topic: DataFrame) -> DataFrame:
    """Configuration change records."""
    return records(topic, schemas.DIM_CONFIG_CHANGE)


def order_detail_records(topic: DataFrame) -> DataFrame:
    """The order-detail topic read back. It carries the time in seconds."""
    rows = records(topic, schemas.ORDER_DETAIL)
    return rows.withColumn("row_time", seconds_to_time(F.col("ts")))
