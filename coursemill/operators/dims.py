"""Dimension upkeep driven by a configuration table.

A configuration row says which source table feeds which dimension, which columns are kept and
which column is the key. Everything goes by arrival order, not by the records' own time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill.operators.asof import as_of
from coursemill.schemas import DIM_CONFIG

CONFIG_FIELDS = DIM_CONFIG.names
# One configuration row per source table of one database; beyond this it is not broadcast.
CONFIG_ROWS = 10_000


def config_changes(records: DataFrame) -> DataFrame:
    """Change records (op, before, after, arrival) to one configuration row each.

    A deletion speaks of the row before, anything else of the row after.
    """
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return records.select("op", *[row[f].alias(f) for f in CONFIG_FIELDS], "arrival")


def preloaded(config: DataFrame, arrival) -> DataFrame:
    """A configuration table read at start, as change rows ahead of all changes."""
    return config.select(F.lit("r").alias("op"), *CONFIG_FIELDS, arrival.alias("arrival"))


def current_config(changes: DataFrame) -> DataFrame:
    """The last row of each source table, unless that was a deletion."""
    last = changes.groupBy("source_table").agg(
        F.max_by(F.struct("op", *[f for f in CONFIG_FIELDS if f != "source_table"]),
                 "arrival").alias("row"))
    return last.select("source_table", "row.*").where("op <> 'd'").select(*CONFIG_FIELDS)


def resets(changes: DataFrame) -> DataFrame:
    """When each dimension was last emptied: an update or deletion of its configuration."""
    return (changes.where(F.col("op").isin("u", "d"))
            .groupBy("sink_table").agg(F.max("arrival").alias("reset_at")))


def _small(df: DataFrame, rows: int = CONFIG_ROWS) -> DataFrame:
    """Broadcast after counting; a larger side is left to Spark."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def keep_columns(data, columns_text):
    """The entries of ``data`` named in a comma-separated text, names taken as they are."""
    names = F.split(columns_text, ",")
    return F.map_filter(data, lambda name, _: F.array_contains(names, name))


def route(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Change rows of configured tables: sink_table, row_key, op, kept columns, arrival.

    The key is looked up among the kept columns, so a whitelist without it gives a NULL key.
    """
    config = _small(config.select("source_table", "sink_table", "sink_columns", "sink_row_key"))
    kept = changes.join(config, changes["table"] == config["source_table"], "inner").withColumn(
        "cols", keep_columns(F.col("data"), F.col("sink_columns")))
    return kept.select("sink_table", F.col("cols")[F.col("sink_row_key")].alias("row_key"),
                       F.col("type").alias("op"), "cols", "arrival")


def route_as_of(changes: DataFrame, config: DataFrame, **options: int) -> DataFrame:
    """Change rows routed by the configuration that was valid when each arrived.

    ``config`` has the configuration's change rows (:func:`config_changes`, :func:`preloaded`),
    numbered in the arrival order of the changes; a change of the configuration counts from its
    own number on. ``options`` are those of :func:`coursemill.operators.asof.as_of`: a source table
    that has most of the change rows is split by arrival.
    """
    found = as_of(changes, config, "table", "source_table",
                  ["op", "sink_table", "sink_columns", "sink_row_key"], "_config", **options)
    kept = found.where("_config.op <> 'd'").withColumn(
        "cols", keep_columns(F.col("data"), F.col("_config.sink_columns")))
    return kept.select(
        "_config.sink_table", F.col("cols")[F.col("_config.sink_row_key")].alias("row_key"),
        F.col("type").alias("op"), "cols", "arrival")


def without_key(routed: DataFrame) -> DataFrame:
    """Routed rows that name no dimension row, for the quarantine."""
    return routed.where("row_key IS NULL")


def after_reset(routed: DataFrame, reset_times: DataFrame) -> DataFrame:
    """Drop rows written before their dimension was last emptied."""
    return (routed.join(_small(reset_times), "sink_table", "left")
            .where(F.col("reset_at").isNull() | (F.col("arrival") > F.col("reset_at")))
            .drop("reset_at"))


def apply_changes(routed: DataFrame) -> DataFrame:
    """Routed rows to the dimension rows they leave: sink_table, row_key, cols.

    A deletion removes the row. Anything else sets its non-NULL columns only, so a column set
    to NULL keeps the old value. Each column is its newest value after the row's last
    deletion, found by aggregates that combine on the map side; the second one sees at most
    one row per kept column of a dimension row.
    """
    rows = _rows_of_cells(routed)
    alive = _alive()
    return (
        rows.withColumn("cells", alive).where(F.size("cells") > 0)
        .select("sink_table", "row_key", F.map_from_entries(F.transform(
            F.array_sort("cells"), lambda c: F.struct(c["name"], c["value"]))).alias("cols"))
    )


def _rows_of_cells(routed: DataFrame) -> DataFrame:
    """Dimension rows as the newest value of each column, and when the row was last deleted."""
    keyed = routed.where("row_key IS NOT NULL")
    is_delete = F.coalesce(F.col("op") == "delete", F.lit(False))
    nothing = F.lit(None).cast("string")
    entries = F.when(is_delete, F.array(F.struct(nothing.alias("key"), nothing.alias("value")))
                     ).otherwise(F.filter(F.map_entries("cols"), lambda e: e["value"].isNotNull()))
    cells = (
        keyed.select("sink_table", "row_key", "arrival", F.explode(entries).alias("cell"))
        .groupBy("sink_table", "row_key", F.col("cell.key").alias("name"))
        .agg(F.max_by("cell.value", "arrival").alias("value"),
             F.max("arrival").alias("set_at"))
    )
    return cells.groupBy("sink_table", "row_key").agg(
        F.max(F.when(F.col("name").isNull(), F.col("set_at"))).alias("deleted_at"),
        F.collect_list(F.when(F.col("name").isNotNull(), F.struct("name", "value", "set_at"))
                       ).alias("cells"))


def _alive() -> Column:
    return F.filter("cells", lambda c: F.col("deleted_at").isNull()
                    | (c["set_at"] > F.col("deleted_at")))


def compacted(routed: DataFrame) -> DataFrame:
    """The fewest change rows that say the same: one per column still set, and the last deletion.

    They have the columns of routed rows, so they stand for all rows they were made from, before
    newer ones as well.
    """
    nothing = F.lit(None).cast("map<string,string>")

    def change(op: str, cols: Column, arrival: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), cols.alias("cols"), arrival.alias("arrival"))

    # One pass gives both kinds of rows.
    sets = F.transform(_alive(), lambda c: change(
        "update", F.create_map(c["name"], c["value"]), c["set_at"]))
    deletions = F.when(F.col("deleted_at").isNotNull(), F.array(
        change("delete", nothing, F.col("deleted_at")))).otherwise(F.array())
    return _rows_of_cells(routed).select(
        "sink_table", "row_key", F.explode(F.concat(sets, deletions)).alias("_change")).select(
        "sink_table", "row_key", "_change.*")


def as_table(dimensions: DataFrame, sink_table: str, *columns: str) -> DataFrame:
    """One dimension as a plain table with its key as ``id``."""
    return dimensions.where(F.col("sink_table") == sink_table).select(
        F.col("row_key").alias("id"),
        *[F.col("cols")[c].alias(c) for c in columns if c != "id"])
