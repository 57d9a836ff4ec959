"""Topics: message logs read as streams of (value, arrival).

``arrival`` is a message's place in its partition. A producer that keys messages keeps all
messages of a key in one partition, so this orders the messages of each key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import LongType, StringType, StructField, StructType

TOPIC_ROW = StructType([StructField("value", StringType()), StructField("arrival", LongType())])


def kafka_read_options(servers: str, topic: str, rows_per_trigger: int = 5_000_000
                       ) -> dict[str, str]:
    """Start at the newest message, and read committed messages only.

    The row limit bounds what one micro-batch can hold of one key; it drops nothing.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "kafka.isolation.level": "read_committed",
        "maxOffsetsPerTrigger": str(rows_per_trigger),
    }


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A topic as a stream. Messages without content keep a NULL value."""
    reader: DataStreamReader = spark.readStream.format("kafka")
    rows = reader.options(**{**kafka_read_options(servers, topic), **options}).load()
    return rows.select(F.col("value").cast("string").alias("value"),
                       F.col("offset").alias("arrival"))


def read_folder(spark: SparkSession, path: str, schema: StructType = TOPIC_ROW,
                files_per_trigger: int = 1000, **options: str) -> DataFrame:
    """A folder of Parquet files as a stream; new files are new messages."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .options(**options).parquet(path))


def to_messages(df: DataFrame, topic: str, *drop: str) -> DataFrame:
    """Rows as JSON messages of a topic. NULL fields are left out."""
    return df.drop(*drop).select(F.lit(topic).alias("topic"),
                                 F.to_json(F.struct("*")).alias("value"))
