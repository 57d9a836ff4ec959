"""What was valid when a row arrived: point-in-time joins with versions of a table.

A version holds from its arrival until the next version of its key arrives. ``as_of`` gives each
row the version that holds at its arrival, by one sort of rows and versions together rather than a
join on a range, so neither a key with many versions nor one with many rows makes
pairs. Keys with over ``hot_rows`` rows are cut into chunks of the arrival order, and the version
that holds at the start of a chunk enters it as a row of its own, as in :mod:`.state`. Only the last
version of a chunk can enter a later one, so of a hot key one row per chunk comes together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursemill.operators.joins import HOT_ROWS, hot_keys, to_join
from coursemill.operators.state import CHUNK, chunk_of


def intervals(versions: DataFrame, key: str, arrival: str = "arrival") -> DataFrame:
    """Versions with ``valid_to``, the arrival of the key's next one, NULL for the last."""
    return versions.withColumn("valid_to", F.lead(arrival).over(
        Window.partitionBy(key).orderBy(arrival)))


def as_of(rows: DataFrame, versions: DataFrame, key: str, version_key: str, values: list[str],
          out: str = "version", arrival: str | Column = "arrival",
          version_arrival: str = "arrival", span: int = CHUNK, hot_rows: int = HOT_ROWS
          ) -> DataFrame:
    """Add struct ``out``: ``values`` of the last version up to the row's arrival, or NULL.

    Both arrivals are whole numbers of one order; a version counts for a row with its own
    number. Versions of one key and arrival must not differ. Rows with a NULL key or arrival
    have none. The result does not depend on ``span`` and ``hot_rows``.
    """
    kept = rows.columns
    at = (F.col(arrival) if isinstance(arrival, str) else arrival).cast("bigint")
    rows = rows.withColumns({"_key": F.col(key), "_at": at, "_chunk": chunk_of(at, span)})
    placed = rows.where("_key IS NOT NULL AND _at IS NOT NULL")
    held = versions.select(
        F.col(version_key).alias("_key"), F.col(version_arrival).cast("bigint").alias("_at"),
        F.struct(*values).alias("_held")).where("_key IS NOT NULL AND _at IS NOT NULL")
    held = held.withColumn("_chunk", chunk_of(F.col("_at"), span))
    hot = to_join(hot_keys(placed, "_key", hot_rows))

    def marked(df: DataFrame) -> DataFrame:
        return df.join(hot, "_key", "left").withColumn(
            "_chunk", F.when(F.col("_hot"), F.col("_chunk"))).drop("_hot")

    # The last version of each chunk, and the starts of chunks that have rows, in order: what holds
    # at each start. The versions of a start's own chunk come behind it.
    starts = placed.join(hot, "_key").select("_key", "_chunk").distinct().withColumn(
        "_start", F.lit(True))
    tails = held.join(hot, "_key").groupBy("_key", "_chunk").agg(
        F.max_by("_held", "_at").alias("_held"))
    order = Window.partitionBy("_key").orderBy("_chunk", F.col("_start").isNull())
    entering = (
        starts.unionByName(tails, allowMissingColumns=True)
        .withColumn("_held", F.last("_held", ignorenulls=True).over(order))
        .where("_start AND _held IS NOT NULL")
        .select("_key", "_chunk", "_held"))
    # Columns of their own, not a struct: those that nobody reads are not shuffled.
    both = (
        marked(placed).withColumn("_is_row", F.lit(True))
        .unionByName(marked(held), allowMissingColumns=True)
        .unionByName(entering, allowMissingColumns=True))
    # The entering version has no number and comes first; of one number the version does.
    in_chunk = Window.partitionBy("_key", "_chunk").orderBy("_at", F.col("_is_row").isNotNull())
    found = (both.withColumn(out, F.last("_held", ignorenulls=True).over(in_chunk))
             .where("_is_row").select(*kept, out))
    none = F.lit(None).cast(found.schema[out].dataType)
    return found.unionByName(rows.where("_key IS NULL OR _at IS NULL").select(*kept, none.alias(out)))


def enrich_as_of(rows: DataFrame, versions: DataFrame, key: str, columns: dict[str, str],
                 arrival: str | Column = "arrival", **options: int) -> DataFrame:
    """Inner lookup of dimension columns (dimension name to new name) as they were on arrival.

    Versions are (id, arrival, alive, ...), as :func:`dimension_versions` gives them. A row whose
    dimension row was not there yet, or was deleted, is dropped.
    """
    found = as_of(rows, versions, key, "id", ["alive", *columns], "_found", arrival, **options)
    return found.where("_found.alive").select(
        "*", *[F.col("_found")[name].alias(new) for name, new in columns.items()]).drop("_found")


def dimension_versions(routed: DataFrame, sink_table: str, *columns: str) -> DataFrame:
    """(id, arrival, alive, columns) of one dimension: its row after each of its change rows.

    The rules are those of :func:`coursemill.operators.dims.apply_changes`: a deletion removes the
    row, anything else sets its non-NULL columns only. Change rows of one arrival of a row count
    as one. A row's history is ordered in one group, which spills; it has a row per change.
    """
    is_delete = F.coalesce(F.col("op") == "delete", F.lit(False))
    rows = routed.where((F.col("sink_table") == sink_table) & F.col("row_key").isNotNull()).select(
        F.col("row_key").alias("id"), "arrival", is_delete.alias("_deleted"),
        *[F.col("cols")[c].alias(c) for c in columns])
    history = Window.partitionBy("id").orderBy("arrival")
    lives = rows.withColumn("_life", F.sum(F.col("_deleted").cast("int")).over(history))
    # A deletion begins a life in which nothing is set yet.
    life = Window.partitionBy("id", "_life").orderBy("arrival")
    return lives.select("id", "arrival", (~F.col("_deleted")).alias("alive"), *[
        F.last(F.when(~F.col("_deleted"), F.col(c)), ignorenulls=True).over(life).alias(c)
        for c in columns])
