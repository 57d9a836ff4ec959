"""Connected components of a table of links, in Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill import session
from coursemill.llm.columns import aside


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least node of its neighbourhood."""
    ways = _both_ways(links)
    least = ways.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    low = F.least("low", "a")
    return (ways.join(least, F.col("a") == F.col("node")).where(F.col("b") > F.col("a"))
            .select(low.alias("a"), "b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them. Links: a < b."""
    least = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("low"))
    moved = (links.join(least, F.col("b") == F.col("node")).where(F.col("a") != F.col("low"))
             .select(F.col("low").alias("a"), F.col("a").alias("b")))
    return moved.union(least.select(F.col("low").alias("a"), F.col("node").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of links (a, b): the least node that can be reached.

    Alternates two rounds that pull links to the least node known, until every node is linked to
    its component's least node alone; the number of rounds grows with the logarithm of the
    longest path. Each round is written to the shared folder, which cuts the lineage. Equal
    links, links of a node to itself and nulls change nothing.
    """
    rows = (links.where("a IS NOT NULL AND b IS NOT NULL AND a != b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rows = session.stored(rows, "links")
    state = None
    while True:
        rows = session.stored(_small_star(_large_star(rows)), "links")
        # All links of a finished state lead from a least node; a second round leaves it so.
        new = rows.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            return rows.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
                rows.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        state = new


def firsts(distinct: DataFrame, nodes: DataFrame) -> DataFrame:
    """(of_id, least) of distinct (id, first): the least ``first`` of the id's component."""
    linked = distinct.join(nodes, F.col("id") == F.col("node"))
    least = linked.groupBy(F.col("component").alias("of")).agg(F.min("first").alias("least"))
    linked = linked.join(least, F.col("component") == F.col("of")).select(
        F.col("id").alias("of_id"), "least")
    alone = distinct.join(nodes, F.col("id") == F.col("node"), "left_anti").select(
        F.col("id").alias("of_id"), F.col("first").alias("least"))
    return linked.union(alone)


def kept_of(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The documents that have the least doc_id of their group (doc_id, component_id)."""
    docs, back = aside(docs, "_kept")
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("_kept")).distinct()
    return back(docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi"))
