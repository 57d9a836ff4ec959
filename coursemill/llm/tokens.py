"""Token ids in Parquet files: written in document order, read selectively.

A row holds a document's ids as a list column beside its metadata. Ids are dictionary encoded,
row groups and pages have set sizes, and Parquet's page indexes let a reader that asks for some
documents or for the metadata alone skip the rest.

Documents are range-partitioned by id and sorted, so that the files, in the order of their
``part``, are in ascending id order. A row knows where it starts within its part; the start over
all documents adds the sizes of the parts before it, one number per file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coursemill import session
from coursemill.llm import encoding
from coursemill.llm.columns import table

# Sizes of the file format.
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.enable.dictionary": "true",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.page.write-checksum.enabled": "true",
}
LAYOUT = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, part, part_start, n_tokens, ids) of every text, in ascending id order per part.

    A null text is an empty one and has the end id alone. A null id comes first; rows of
    equal ids are ordered by their text, so equal rows are interchangeable. Other columns are
    left out. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64("text").alias("tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in encoding.chunks(batches):
            ids = encoding.encoded(batch, path)
            sizes = np.diff(ids.bounds)
            starts = at + ids.bounds[:-1]
            at += len(ids.values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(sizes), part, np.int32)),
                 pa.array(starts), pa.array(sizes), encoding.id_lists(ids)],
                names=["doc_id", "part", "part_start", "n_tokens", "ids"])

    return (rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
            .mapInArrow(run, LAYOUT))


def write(docs: DataFrame, vocabulary: str, folder: str) -> None:
    """Encode the documents into files below ``folder``, which must be new or empty."""
    encode(docs, vocabulary).write.options(**FILE_OPTIONS).parquet(folder)


def raw(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of written files as they are; unused columns are not read."""
    return spark.read.schema(LAYOUT).parquet(folder)


def starts(rows: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Rows of written files with ``start``, the ids of all documents before, for their part."""
    sizes = raw(spark, folder).groupBy("part").agg(F.sum("n_tokens").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(F.col("part").alias("of"),  # a row per file
                          F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    return (rows.join(before, F.col("part") == F.col("of"))
            .withColumn("start", F.col("before") + F.col("part_start"))
            .drop("of", "before", "part", "part_start"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, n_tokens, ids, start) of written files."""
    return starts(raw(spark, folder), spark, folder)


def checksums(rows: DataFrame, ids: str = "ids") -> DataFrame:
    """The rows with ``ids_crc32`` in place of the ids."""
    others = [field for field in rows.schema if field.name != ids]
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")
            bounds = lists.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(f.name)) for f in others],
                 pa.array(crc, pa.int64())],
                names=[*[f.name for f in others], "ids_crc32"])

    return rows.mapInArrow(run, f"{layout}, ids_crc32 long")


def query(spark, folder):
    import public_tokenizers

    files = session.work_folder(spark, "token-files")
    write(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), files)
    return starts(checksums(raw(spark, files)), spark, files).select(
        "doc_id", "start", "n_tokens", "ids_crc32")
