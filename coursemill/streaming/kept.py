"""Tables that a stream keeps between its micro-batches, in buckets of their key.

A micro-batch reads only the buckets that its keys fall into, and writes those anew. Each bucket
has one newest folder, named after the batch that wrote it, or at most FOLD of them if rows are only
added; the list of them is written last, as one table per batch. So a batch that broke off or runs again starts from what the batch before it
left, and what is read of a bucket does not grow with the number of batches.

A table belongs to one run of one query: it stands below its checkpoint, or in a folder of its own.
Everything is DataFrame work. A bucket is no unit of work: its rows are written by as
many tasks as hold them, so a key that has most of the rows is not one task's.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64
# Folders of a bucket that rows are only added to, until they are made one.
FOLD = 8
# Rows of a file, at least, if rows are written by the tasks that hold them.
FILE_ROWS = 10_000


def bucket_of(key: Sequence[str | Column], buckets: int = BUCKETS) -> Column:
    """The bucket of a key. NULL is a key like any other."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


class KeptTable:
    """A table of ``schema`` in buckets of ``key`` below ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: Sequence[str],
                 buckets: int = BUCKETS):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.buckets = list(key), buckets

    def _newest(self, before: int | None) -> set[tuple[int, int]]:
        """(bucket, batch) of the folders that hold each bucket, as of the batch before ``before``."""
        if before:  # the list of the batch before is there, but at a start or after a gap
            rows = self._lists(f"{self.path}/lists/of_batch={before - 1}")
            if rows is not None:
                return self._buckets(rows)
        rows = self._lists(f"{self.path}/lists")
        if rows is None:
            return set()
        if before is not None:
            rows = rows.where(F.col("of_batch") < before)
        last = rows.agg(F.max("of_batch")).first()[0]
        return set() if last is None else self._buckets(rows.where(F.col("of_batch") == last))

    def _lists(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    @staticmethod
    def _buckets(rows: DataFrame) -> set[tuple[int, int]]:
        return {(r.bucket, r.batch) for r in rows.where("bucket >= 0").collect()}

    def touched(self, *keyed: DataFrame) -> list[int]:
        """Buckets that rows with the key's columns fall into: at most as many as there are."""
        found = set()
        for rows in keyed:
            found |= {r.bucket for r in rows.select(
                bucket_of(self.key, self.buckets).alias("bucket")).distinct().collect()}
        return sorted(found)

    def read(self, only: Sequence[int] | None = None, before: int | None = None) -> DataFrame:
        """Rows of the newest folders, of some buckets or of all.

        With ``before``, as they were ahead of that batch.
        """
        paths = [f"{self.path}/rows/batch={batch}/bucket={bucket}"
                 for bucket, batch in sorted(self._newest(before))
                 if only is None or bucket in only]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, rows: DataFrame, batch_id: int, touched: Sequence[int]) -> None:
        """Put ``rows`` in the place of all rows of the touched buckets."""
        self._place(rows, batch_id, {p for p in self._newest(batch_id) if p[0] not in touched})

    def append(self, rows: DataFrame, batch_id: int, keep: Column | None = None,
               merge: Callable[[DataFrame], DataFrame] | None = None,
               count: int | None = None) -> None:
        """Add ``rows``, and write nothing else anew but buckets that have FOLD folders: of their
        rows those stay for which ``keep`` holds, and ``merge`` says what they and the new rows
        leave. With ``count``, how many rows there are, many are written without a shuffle."""
        newest = self._newest(batch_id)
        folders = [bucket for bucket, _ in newest]
        full = {bucket for bucket in folders if folders.count(bucket) >= FOLD}
        if full:
            old = self.read(sorted(full), before=batch_id)
            rows = rows.unionByName(old if keep is None else old.where(keep))
            rows = merge(rows) if merge else rows
        self._place(rows, batch_id, {p for p in newest if p[0] not in full}, count)

    def _place(self, rows: DataFrame, batch_id: int, newest: set[tuple[int, int]],
               count: int | None = None) -> None:
        """Write a batch's folders, and the list of them and of ``newest``."""
        folder = f"{self.path}/rows/batch={batch_id}"
        placed = rows.select(*self.schema.names).withColumn(
            "bucket", bucket_of(self.key, self.buckets))
        # A small bucket becomes one file, a large one is split: by the tasks that hold its rows if they
        # have enough for a file of each bucket, else by a shuffle.
        tasks = (count or 0) // (FILE_ROWS * self.buckets)
        placed = (placed.coalesce(tasks) if tasks >= self.spark.sparkContext.defaultParallelism
                  else placed.hint("rebalance", "bucket"))
        placed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            "bucket").parquet(folder)
        try:  # buckets that have rows now
            written = self.spark.read.parquet(folder).select("bucket").distinct().collect()
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            written = []
        newest = newest | {(r.bucket, batch_id) for r in written}
        # The row without a bucket is there when no bucket has rows.
        self.spark.createDataFrame(
            [(-1, batch_id), *sorted(newest)], "bucket int, batch long").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.path}/lists/of_batch={batch_id}")

    def written(self, batch_id: int) -> set[int]:
        """Buckets that a batch has written rows of."""
        return {bucket for bucket, batch in self._newest(batch_id + 1) if batch == batch_id}

    def folders(self) -> int:
        """Folders that a read of all rows opens."""
        return len(self._newest(None))
