"""Writers for micro-batches. A replayed batch replaces all that it wrote, so nothing counts twice.

What a batch writes stands below the run and the batch it belongs to. A run is a query with its
checkpoint: another query, or the same one with a new checkpoint, has its own batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from coursemill.operators import dims
from coursemill.operators.enrich import enrich, without_dimension
from coursemill.operators.upsert import latest_per_key

# Fixed value: seconds between micro-batches, which is also the checkpoint interval.
EVERY = "5 seconds"

WriteBatch = Callable[[DataFrame, int, str], None]

# Columns that tell where a row was written.
PLACE = ("run", "batch_id")


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (),
                run: str = "", rebalance: bool = True) -> None:
    """Write a batch's rows to its own part of a Parquet table, in place of what is there.

    Rows are rebalanced by partition: a small partition becomes one file, a large one is split.
    Without ``rebalance`` they are written as they come.
    """
    part = f"{path}/run={run or 'none'}/batch_id={batch_id}"
    df = df.hint("rebalance", *partition_by) if rebalance else df
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(part))


def start(stream: DataFrame, write: WriteBatch, checkpoint: str, every: str | None = EVERY,
          mode: str = "append") -> StreamingQuery:
    """Run until stopped, or, with ``every=None``, over what is there now."""
    run = "r" + hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    writer = stream.writeStream.outputMode(mode).foreachBatch(
        lambda df, batch_id: write(df, batch_id, run)).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_print(stream: DataFrame, checkpoint: str, every: str | None = EVERY, rows: int = 20
                ) -> StreamingQuery:
    """Show the first rows of each micro-batch on the console, for a look at a running job."""
    writer = stream.writeStream.format("console").option("numRows", rows).option(
        "truncate", False).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_kafka(messages: DataFrame, servers: str, checkpoint: str, every: str = EVERY
                ) -> StreamingQuery:
    """Send (topic, value) rows; each goes to the topic it names."""
    return (messages.select("topic", "value").writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint)
            .trigger(processingTime=every).start())


def topics_writer(path: str) -> WriteBatch:
    """(topic, value) rows to one folder per topic, all in one pass."""
    return lambda df, batch_id, run="": write_batch(df, path, batch_id, ["topic"], run)


def keyed_writer(path: str) -> WriteBatch:
    """Rows of a keyed table, as they come; :func:`read_keyed` shows the last of each key."""
    return lambda df, batch_id, run="": write_batch(df, path, batch_id, run=run)


def job_writer(path: str, job: Callable[[DataFrame], DataFrame],
               partition_by: Sequence[str] = ()) -> WriteBatch:
    """What a batch job makes of each micro-batch, such as a fact with its dimension.

    The job runs anew per micro-batch, so a dimension that it reads is the current one.
    """
    return lambda df, batch_id, run="": write_batch(job(df), path, batch_id, partition_by, run)


def read_keyed(spark: SparkSession, path: str, key: str | Sequence[str]) -> DataFrame:
    """The last row per key: the highest arrival of the newest batch that has the key."""
    rows = spark.read.parquet(path).withColumn("_at", F.struct("batch_id", "arrival"))
    return latest_per_key(rows, key, "_at").drop("_at", *PLACE)


Lookup = tuple[Callable[[], DataFrame], str, dict[str, str]]


def report_writer(path: str, lookups: Sequence[Lookup] = (), quarantine: str | None = None
                  ) -> WriteBatch:
    """Window rows, with names looked up, to a report table partitioned by day.

    Each lookup is (function reading the dimension, key, columns). Dimensions are read anew for
    each batch, so names are current. Rows without a dimension row go to ``quarantine``.
    """
    def write(df: DataFrame, batch_id: int, run: str = "") -> None:
        rows = df
        for number, (read, key, columns) in enumerate(lookups):
            dim = read()
            if quarantine:
                write_batch(without_dimension(rows, dim, key),
                            f"{quarantine}/{number}-{key}", batch_id, run=run)
            rows = enrich(rows, dim, key, columns)
        write_batch(rows, path, batch_id, ["cur_date"], run)

    def write_once_computed(df: DataFrame, batch_id: int, run: str = "") -> None:
        # Both outputs come from one computed batch; a lost block is computed again.
        df = df.persist()
        try:
            write(df, batch_id, run)
        finally:
            df.unpersist()

    return write_once_computed if quarantine else write


def window_parts_writer(path: str, windows: Callable[[DataFrame], DataFrame]) -> WriteBatch:
    """Window rows of each batch by itself, as parts that :func:`read_windows` adds up.

    No watermark is needed and no row is too late: a row that comes after its window was
    written adds another part to it. So the sums do not depend on how the input is cut into
    batches.
    """
    return lambda df, batch_id, run="": write_batch(
        windows(df), path, batch_id, ["cur_date"], run)


def read_windows(spark: SparkSession, path: str, sums: Sequence[str], folded: str | None = None
                 ) -> DataFrame:
    """Window rows from their parts: all columns but ``sums`` are the key.

    With ``folded``, what :func:`fold_windows` wrote stands for the parts that it covers.
    """
    day = F.col("cur_date").cast("string")
    log = spark.read.parquet(path).withColumn("run", F.col("run").cast("string"))
    number, covered = _snapshot(spark, folded) if folded else (0, {})
    parts = _since(log, covered).drop(*PLACE).withColumn("cur_date", day)
    if number:
        parts = parts.unionByName(
            spark.read.parquet(f"{folded}/rows/number={number}").withColumn("cur_date", day))
    keys = [c for c in parts.columns if c not in sums]
    kinds = dict(parts.dtypes)
    return parts.groupBy(*keys).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in sums])


def _since(log: DataFrame, covered: dict[str, int]) -> DataFrame:
    """Rows of the batches that a snapshot does not cover."""
    old = F.lit(False)
    for run, last in covered.items():
        old = old | ((F.col("run") == run) & (F.col("batch_id") <= last))
    return log.where(~old)


def fold_windows(spark: SparkSession, path: str, sums: Sequence[str], folded: str) -> int:
    """Add up the parts of all batches so far into a snapshot in order of days, and give its number.

    It is not partitioned by day: trade has thousands of days, and a file for each takes a task
    longer than the sums do.

    A part that comes later stands beside the snapshot until the next one, so a late row reopens its
    window. One caller at a time, between batches, as for :func:`compact_dimensions`.
    """
    number = _snapshot(spark, folded)[0] + 1
    within = spark.read.parquet(path).groupBy(F.col("run").cast("string").alias("run")).agg(
        F.max("batch_id").cast("long").alias("last_batch"))
    rows = read_windows(spark, path, sums, folded)
    rows.repartitionByRange("cur_date").sortWithinPartitions("cur_date").write.mode(
        "overwrite").parquet(f"{folded}/rows/number={number}")
    within.write.mode("overwrite").parquet(f"{folded}/covered/number={number}")
    return number


def windows_and_late_writer(path: str, late: str, marks: str, time: str,
                            windows: Callable[[DataFrame], DataFrame], seconds: int = 10,
                            disorder_seconds: int = 2) -> WriteBatch:
    """Window rows of each batch, and the rows that came too late for theirs as an output.

    A row is late if its window ended by the watermark that the batches before had reached: the
    greatest time so far less the disorder. The watermark is kept per batch, so a replay
    splits alike. Windows and late rows together are all rows with a time; rows without one are
    late. Windows that end by the last watermark (:func:`watermark_seconds`) are closed.
    """
    def write(df: DataFrame, batch_id: int, run: str = "") -> None:
        reached = watermark_seconds(df.sparkSession, marks, batch_id)
        end = (F.floor(F.unix_seconds(F.col(time)) / seconds) + 1) * seconds
        in_time = F.lit(True) if reached is None else end > F.lit(reached)
        in_time = F.coalesce(in_time & F.col(time).isNotNull(), F.lit(False))
        write_batch(windows(df.where(in_time)), path, batch_id, ["cur_date"], run)
        write_batch(df.where(~in_time), late, batch_id, run=run)
        newest = df.agg(F.max(F.unix_micros(F.col(time)))).first()[0]
        new = [v for v in (reached, None if newest is None else newest / 1e6 - disorder_seconds)
               if v is not None]
        df.sparkSession.createDataFrame(
            [(max(new) if new else None,)], "watermark double").coalesce(1).write.mode(
            "overwrite").parquet(f"{marks}/batch={batch_id}")

    return write


def watermark_seconds(spark: SparkSession, marks: str, before: int | None = None) -> float | None:
    """The watermark after all batches, or ahead of one, in seconds since the epoch."""
    try:
        rows = spark.read.schema("watermark double, batch long").parquet(marks)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.where(F.lit(True) if before is None else F.col("batch") < before).agg(
        F.max("watermark")).first()[0]


def marked(write: WriteBatch, marks: str) -> WriteBatch:
    """One commit for all that a batch writes: a marker, put down when everything is there.

    :func:`read_marked` shows a batch's rows of any output once its marker is there, so a reader
    never sees half a batch, whichever outputs a broken one has written.
    """
    def run_and_mark(df: DataFrame, batch_id: int, run: str = "") -> None:
        write(df, batch_id, run)
        df.sparkSession.createDataFrame([(run or "none", batch_id)], "run string, batch_id long"
                                        ).coalesce(1).write.mode("overwrite").parquet(
            f"{marks}/of={run or 'none'}-{batch_id}")

    return run_and_mark


def read_marked(spark: SparkSession, path: str, marks: str, schema: StructType) -> DataFrame:
    """Rows of one output of the batches that are marked; none before the first marker."""
    try:
        done = spark.read.parquet(marks).select("run", "batch_id").distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    rows = spark.read.parquet(path).withColumns({
        "run": F.col("run").cast("string"), "batch_id": F.col("batch_id").cast("long")})
    return rows.join(done, ["run", "batch_id"], "left_semi").select(*schema.names)


def dimension_writer(path: str, config: Callable[[], DataFrame], quarantine: str | None = None
                     ) -> WriteBatch:
    """Change rows, routed by the configuration as it is now, appended to the dimension log."""
    def write(changes: DataFrame, batch_id: int, run: str = "") -> None:
        routed = dims.route(changes, config())
        if quarantine:
            write_batch(dims.without_key(routed), quarantine, batch_id, run=run)
        write_batch(routed.where("row_key IS NOT NULL"), path, batch_id, ["sink_table"], run)

    return write


def read_routed(spark: SparkSession, changes: str, config: str, **options: int) -> DataFrame:
    """Change rows of one log, routed by the configuration of another as of their arrival.

    Both logs are what :func:`keyed_writer` appends. However their inputs were cut into batches, and
    whichever was ahead, the result is that of all rows in order of arrival.
    """
    return dims.route_as_of(spark.read.parquet(changes).drop(*PLACE),
                            spark.read.parquet(config).drop(*PLACE), **options)


def _snapshot(spark: SparkSession, snapshots: str) -> tuple[int, dict[str, int]]:
    """Number of the newest snapshot, 0 for none, and the last batch of each run within it."""
    try:
        covered = spark.read.parquet(f"{snapshots}/covered")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, {}
    number = covered.agg(F.max("number")).first()[0]
    return number, {r.run: r.last_batch for r in covered.where(
        F.col("number") == number).collect()}  # a row per run


def dimension_log(spark: SparkSession, path: str, snapshots: str | None = None) -> DataFrame:
    """Change rows of the newest snapshot and of the batches since; all batches without one."""
    log = spark.read.parquet(path).withColumn("run", F.col("run").cast("string"))
    number, covered = _snapshot(spark, snapshots) if snapshots else (0, {})
    columns = ["sink_table", "row_key", "op", "cols", "arrival"]
    if not number:
        return log.select(*columns)
    return spark.read.parquet(f"{snapshots}/rows/number={number}").select(*columns).unionByName(
        _since(log, covered).select(*columns))


def compact_dimensions(spark: SparkSession, path: str, snapshots: str) -> int:
    """Write a new snapshot of the dimension log and give its number. One caller at a time.

    A snapshot counts once the list of the batches within it is written, which is last; a
    broken compaction is written anew under its number. Only batches that are complete may be
    there: call it between batches, as after :func:`dimension_writer` in the same function.
    """
    number = _snapshot(spark, snapshots)[0] + 1
    within = spark.read.parquet(path).groupBy(F.col("run").cast("string").alias("run")).agg(
        F.max("batch_id").cast("long").alias("last_batch"))
    rows = dims.compacted(dimension_log(spark, path, snapshots))
    rows.write.mode("overwrite").parquet(f"{snapshots}/rows/number={number}")
    within.write.mode("overwrite").parquet(f"{snapshots}/covered/number={number}")
    return number


def read_dimensions(spark: SparkSession, path: str, resets: DataFrame | None = None,
                    snapshots: str | None = None) -> DataFrame:
    """The dimension rows that a dimension log leaves: sink_table, row_key, cols."""
    log = dimension_log(spark, path, snapshots)
    return dims.apply_changes(log if resets is None else dims.after_reset(log, resets))


def dropped_late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark and were dropped, over the kept progress reports."""
    return sum(operator["numRowsDroppedByWatermark"]
               for progress in query.recentProgress for operator in progress["stateOperators"])
