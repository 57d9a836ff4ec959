"""Streaming jobs that carry rows between micro-batches in kept tables, without a Python worker.

Each of them is a function for ``foreachBatch``: it reads the buckets that a micro-batch touches,
runs a batch job over them and the new rows, writes the result, and then the buckets. The jobs
are the ones for whole tables, so hot keys are cut into chunks here as well, and a replay
of a batch starts from the state ahead of it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from coursemill.operators import state
from coursemill.operators.upsert import latest_per_key
from coursemill.streaming.kept import BUCKETS, KeptTable
from coursemill.streaming.sinks import WriteBatch, write_batch
from coursemill.streaming.state import ONE_DAY_MS

Clock = Callable[[], int]
Finish = Callable[[DataFrame], DataFrame]


def now_ms() -> int:
    return int(time.time() * 1000)


def once_computed(write: WriteBatch) -> WriteBatch:
    """Compute a micro-batch's rows once, though several outputs and kept tables come from them."""
    def run(df: DataFrame, batch_id: int, run: str = "") -> None:
        if df.is_cached:  # by the caller, which may need them after this
            return write(df, batch_id, run)
        df = df.persist()
        try:
            write(df, batch_id, run)
        finally:
            df.unpersist()

    return run


def together(*writers: WriteBatch) -> WriteBatch:
    """Several writers as one: a micro-batch is read and computed once for all of them."""
    def write(df: DataFrame, batch_id: int, run: str = "") -> None:
        for writer in writers:
            writer(df, batch_id, run)

    return once_computed(write)


# --- memory of the row before ----------------------------------------------------------------


def _flags_writer(path: str, table: str, key: str, held: Sequence[str],
                  job: Callable[[DataFrame], DataFrame], lasting: Column, idle_ms: int | None,
                  clock: Clock, buckets: int, finish: Finish | None) -> WriteBatch:
    """Rows of ``job`` over the new rows and, ahead of them, the last row of each of their keys.

    ``finish`` is what to write of the new rows with their flags, such as window parts.

    A key's last row is kept as its ``held`` columns; in front of the new rows it stands for the
    history before them. A key's rows have to come in order of arrival. A key without rows for
    ``idle_ms`` is forgotten, unless its last row is ``lasting``.
    """
    def write(df: DataFrame, batch_id: int, run: str = "") -> None:
        kinds, now = df.schema, clock()
        schema = StructType([kinds[key], *[kinds[c] for c in held], kinds["arrival"],
                             StructField("_seen", LongType())])
        kept = KeptTable(df.sparkSession, table, schema, [key], buckets)
        touched = kept.touched(df)
        before = kept.read(touched, before=batch_id)
        if idle_ms is not None:
            before = before.where((F.col("_seen") >= now - idle_ms) | lasting)
        both = df.withColumn("_new", F.lit(True)).unionByName(
            before.drop("_seen").withColumn("_new", F.lit(False)), allowMissingColumns=True)
        flagged = job(both).where("_new").drop("_new")
        write_batch(finish(flagged) if finish else flagged, path, batch_id, run=run)
        last = df.groupBy(key).agg(
            F.max_by(F.struct(*held, "arrival"), "arrival").alias("row")).select(
            key, "row.*", F.lit(now).alias("_seen"))
        others = before.join(last.select(F.col(key).alias("_now")),
                             F.col(key).eqNullSafe(F.col("_now")), "left_anti")
        kept.write(others.unionByName(last), batch_id, touched)

    return once_computed(write)


def visit_flags_writer(path: str, table: str, key: str = "mid", chunk: Column | None = None,
                       hot_rows: int = state.HOT_ROWS, idle_ms: int | None = ONE_DAY_MS,
                       clock: Clock = now_ms, buckets: int = BUCKETS,
                       finish: Finish | None = None) -> WriteBatch:
    """Rows with visit flags, as :func:`coursemill.operators.state.visit_flags` makes them.

    After an idle day the last day is of no more use, but a session start still is.
    """
    return _flags_writer(
        path, table, key, ("visit_date", "last_page_id"),
        lambda rows: state.visit_flags(
            rows, state.chunk_of("arrival") if chunk is None else chunk, key, hot_rows=hot_rows),
        state.starts_session(F.col("last_page_id")), idle_ms, clock, buckets, finish)


def first_order_writer(path: str, table: str, key: str = "user_id", chunk: Column | None = None,
                       hot_rows: int = state.HOT_ROWS, idle_ms: int | None = ONE_DAY_MS,
                       clock: Clock = now_ms, buckets: int = BUCKETS,
                       finish: Finish | None = None) -> WriteBatch:
    """Order rows with :func:`coursemill.operators.state.daily_first_order_flag`."""
    return _flags_writer(
        path, table, key, ("order_date",),
        lambda rows: state.daily_first_order_flag(
            rows, state.chunk_of("arrival") if chunk is None else chunk, key, hot_rows=hot_rows),
        F.lit(False), idle_ms, clock, buckets, finish)


def repair_writer(path: str, table: str, key: str = "mid", hot_rows: int = state.HOT_ROWS,
                  buckets: int = BUCKETS, finish: Finish | None = None) -> WriteBatch:
    """Rows with the new-visitor flag repaired: a key's first row is kept for good."""
    def write(df: DataFrame, batch_id: int, run: str = "") -> None:
        spark, kinds = df.sparkSession, df.schema
        schema = StructType([kinds[key], kinds["visit_date"], kinds["is_new"], kinds["arrival"]])
        kept = KeptTable(spark, table, schema, [key], buckets)
        touched = kept.touched(df)
        before = kept.read(touched, before=batch_id)
        both = df.withColumn("_new", F.lit(True)).unionByName(
            before.withColumn("_new", F.lit(False)), allowMissingColumns=True)
        fixed = state.repair_new_visitor(both, key, hot_rows=hot_rows).where("_new").drop("_new")
        write_batch(finish(fixed) if finish else fixed, path, batch_id, run=run)
        first = df.groupBy(key).agg(F.min_by(
            F.struct("visit_date", "is_new", "arrival"), "arrival").alias("row")).select(
            key, "row.*")
        new = first.join(before.select(F.col(key).alias("_known")),
                         F.col(key).eqNullSafe(F.col("_known")), "left_anti")
        kept.write(before.unionByName(new), batch_id, touched)

    return once_computed(write)


# --- last row per key -------------------------------------------------------------------------


def keyed_merge_writer(table: str, key: Sequence[str], schema: StructType,
                       buckets: int = BUCKETS) -> WriteBatch:
    """Rows of a table of which :func:`read_merged` shows the last one of each key.

    A batch adds its rows to their buckets and reads none; a bucket with FOLD folders becomes one,
    with the last row of each key. So a batch costs its own rows, not those of the table.
    """
    def write(df: DataFrame, batch_id: int, run: str = "") -> None:
        KeptTable(df.sparkSession, table, schema, key, buckets).append(
            df.select(*schema.names), batch_id,
            merge=lambda rows: latest_per_key(rows, list(key), "arrival"))

    return write


def read_merged(spark: SparkSession, table: str, key: Sequence[str], schema: StructType,
                buckets: int = BUCKETS) -> DataFrame:
    """The last row of each key: at most FOLD folders per bucket, however many batches there were."""
    return latest_per_key(KeptTable(spark, table, schema, key, buckets).read(), list(key), "arrival")


# --- joins with an idle time to live --------------------------------------------------------------


# Places that the keys of one side of a join are marked at, a bit each; so the marks take at most 8 MB.
PLACES = 1 << 26


def may_meet(rows: DataFrame, key: str, new: str, others: DataFrame, other_key: str, other_new: str
             ) -> DataFrame:
    """``rows`` without most of those that make no new pair, which so stay out of the join's shuffle.

    An old row makes one with a new row of ``others`` only. Their keys are marked at their hashes'
    places; keys that share a place let a row through for nothing, and none is left out that meets
    another. The marks are broadcast, as at most PLACES / 64 numbers.
    """
    def place(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(PLACES))

    def bit(name: str) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"),
                               F.pmod(place(name), F.lit(64)).cast("int"))

    marks = others.select(
        F.floor(place(other_key) / 64).alias("_word"), bit(other_key).alias("_bit"), other_new
    ).groupBy("_word").agg(
        F.bit_or("_bit").alias("_any"),
        F.coalesce(F.bit_or(F.when(F.col(other_new), F.col("_bit"))), F.lit(0)).alias("_fresh"))
    mark = F.when(F.col(new), F.col("_any")).otherwise(F.col("_fresh"))
    return rows.withColumn("_word", F.floor(place(key) / 64)).join(
        F.broadcast(marks), "_word").where(mark.bitwiseAND(bit(key)) != 0).select(*rows.columns)


class WaitingJoin:
    """Inner equi-join of two inputs whose rows wait for each other for ``ttl_ms``, or for a time
    of each side's own.

    The time to live is that of the wall clock: a row waits from the batch that brought it, and
    every batch that begins later than ``ttl_ms`` after that one no longer sees it. Rows that
    have waited too long leave their bucket when it is next touched, or by :meth:`expire`.
    The left side is the one with the wider rows: only what may meet a row is shuffled of it.
    """

    def __init__(self, spark: SparkSession, path: str, left: StructType, right: StructType,
                 left_key: str, right_key: str, ttl_ms: int | tuple[int, int],
                 buckets: int = BUCKETS):
        self.keys = (left_key, right_key)
        self.ttls = ttl_ms if isinstance(ttl_ms, tuple) else (ttl_ms, ttl_ms)
        waits = [StructField("_since", LongType()), StructField("_batch", LongType())]
        self.tables = tuple(
            KeptTable(spark, f"{path}/{name}", StructType([*schema, *waits]), [key], buckets)
            for name, schema, key in (("left", left, left_key), ("right", right, right_key)))

    def advance(self, left: DataFrame, right: DataFrame, batch_id: int, now: int) -> DataFrame:
        """Pairs in which at least one row is new; the new rows wait from now on."""
        return self.met(left, right, batch_id, now).drop("_since_0", "_since_1")

    def met(self, left: DataFrame, right: DataFrame, batch_id: int, now: int,
            lefts: int | None = None) -> DataFrame:
        """The same with the times since when both rows wait. ``lefts`` is the count of the left
        rows, if it is known."""
        waiting = [F.col("_since") >= now - ttl for ttl in self.ttls]
        for table, rows, key, keep, count in zip(
                self.tables, (left, right), self.keys, waiting, (lefts, None), strict=True):
            # A NULL key never meets another row.
            table.append(rows.where(F.col(key).isNotNull()).withColumns({
                "_since": F.lit(now).cast("bigint"), "_batch": F.lit(batch_id).cast("bigint")}),
                batch_id, keep, count=count)
        # The new rows are read back with the old ones, so each side is shuffled once, and what made
        # the new rows is not run again. A key is in the bucket of the same number on both sides.
        touched = sorted({b for table in self.tables for b in table.written(batch_id)})
        one, other = (
            table.read(touched, before=batch_id + 1).where(keep).withColumn(
                f"_new_{n}", F.col("_batch") == batch_id).drop("_batch").withColumnRenamed(
                "_since", f"_since_{n}")
            for n, (table, keep) in enumerate(zip(self.tables, waiting, strict=True)))
        one = may_meet(one, self.keys[0], "_new_0", other, self.keys[1], "_new_1")
        on = F.col(self.keys[0]) == F.col(self.keys[1])
        return one.join(other, on & (F.col("_new_0") | F.col("_new_1"))).drop("_new_0", "_new_1")

    def expire(self, batch_id: int, now: int) -> None:
        """Drop all rows that have waited too long, in every bucket."""
        for table, ttl_ms in zip(self.tables, self.ttls, strict=True):
            every = list(range(table.buckets))
            table.write(table.read(every, before=batch_id).where(
                F.col("_since") >= now - ttl_ms), batch_id, every)

    def waiting(self) -> tuple[int, int]:
        return tuple(table.read().count() for table in self.tables)


def order_detail_writer(path: str, tables: str, split: Callable[[DataFrame], Sequence[DataFrame]],
                        finish: Callable[[DataFrame], DataFrame], schemas: Sequence[StructType],
                        ttl_ms: int, clock: Clock = now_ms, buckets: int = BUCKETS,
                        reread: bool = False) -> WriteBatch:
    """Order lines, their header and their session's views, each waiting at most ``ttl_ms``.

    ``split`` gives the lines (with order_id), headers (``_order_id``, session_id) and views
    (``_sid``) of a micro-batch, ``schemas`` are theirs, and ``finish`` makes rows of what met.
    With ``reread`` a micro-batch is read for each of them, instead of kept in memory or on disk while it
    is written; it is for streams whose rows are read as they are.

    A line and its header wait for each other, and then, from when they met, the two and a view do.
    The joins run the other way round, so that the wide rows of the lines are kept once and join last:
    headers meet views, and lines the pairs. Until the times of all three are known, headers and
    lines may have to wait twice as long; the times decide. The two joins follow each other within a
    batch: what the first one finds is new for the second.
    """
    lines, headers, views = schemas
    pairs = StructType([*headers, *views, StructField("_header_at", LongType()),
                        StructField("_view_at", LongType())])

    def write(df: DataFrame, batch_id: int, run: str = "") -> None:
        spark, now = df.sparkSession, clock()
        waits = (2 * ttl_ms, ttl_ms)
        first = WaitingJoin(spark, f"{tables}/sessions", headers, views, "session_id", "_sid",
                            waits, buckets)
        second = WaitingJoin(spark, f"{tables}/orders", lines, pairs, "order_id", "_order_id",
                             waits, buckets)
        own = split(df)
        paired = first.met(own[1], own[2], batch_id, now).withColumnsRenamed(
            {"_since_0": "_header_at", "_since_1": "_view_at"})
        line_at, header_at, view_at = (F.col(c) for c in ("_since_0", "_header_at", "_view_at"))
        rows = second.met(own[0], paired, batch_id, now, own[0].count()).where(
            (F.abs(line_at - header_at) <= ttl_ms)
            & (F.abs(F.greatest(line_at, header_at) - view_at) <= ttl_ms)).drop(
            "_since_0", "_since_1", "_header_at", "_view_at")
        # The join has put its rows together in partitions of a size; they need no other shuffle.
        write_batch(finish(rows), path, batch_id, run=run, rebalance=False)

    return write if reread else once_computed(write)


# --- lookups that wait ------------------------------------------------------------------------


def parked_lookup_writer(path: str, table: str, quarantine: str,
                         dimension: Callable[[int], DataFrame],
                         key: str, columns: Mapping[str, str], wait_ms: int,
                         clock: Clock = now_ms, buckets: int = BUCKETS) -> WriteBatch:
    """Rows with columns of their dimension row, which may come up to ``wait_ms`` late.

    ``dimension`` gives the dimension as it is when a batch, whose number it is told, runs.
    A row whose dimension row is not there is parked by its key. Each batch looks its own rows and
    the parked ones up again; a row goes on as soon as its dimension row is there, and to the
    quarantine once it has waited too long. So rows in are rows out, parked or set aside. A batch
    without rows, which a trigger by time brings about, also moves them on.
    """
    def write(df: DataFrame, batch_id: int, run: str = "") -> None:
        spark, now = df.sparkSession, clock()
        kept = KeptTable(spark, table, StructType([*df.schema, StructField("_since", LongType())]),
                         [key], buckets)
        rows = df.withColumn("_since", F.lit(now)).unionByName(kept.read(before=batch_id))
        dim = dimension(batch_id).select(F.col("id").alias("_id"), F.lit(True).alias("_there"), *[
            F.col(name).alias(f"_d_{new}") for name, new in columns.items()])
        work = f"{table}/marked/batch={batch_id}"
        rows.join(dim, F.col(key) == F.col("_id"), "left").write.mode("overwrite").parquet(work)
        marked = spark.read.parquet(work)
        late = F.col("_since") < now - wait_ms
        found = marked.where("_there").select(
            *df.columns, *[F.col(f"_d_{new}").alias(new) for new in columns.values()])
        write_batch(found, path, batch_id, run=run)
        missing = marked.where("_there IS NULL")
        write_batch(missing.where(late | F.col(key).isNull()).select(*df.columns), quarantine,
                    batch_id, run=run)
        kept.write(missing.where(~late & F.col(key).isNotNull()).select(*df.columns, "_since"),
                   batch_id, list(range(buckets)))

    return write


def parked(spark: SparkSession, table: str, schema: StructType, key: str,
           buckets: int = BUCKETS) -> DataFrame:
    """Rows of ``schema`` that still wait for their dimension row."""
    kept = KeptTable(spark, table, StructType([*schema, StructField("_since", LongType())]), [key],
                     buckets)
    return kept.read().drop("_since")
