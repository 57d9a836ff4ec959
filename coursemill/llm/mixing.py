"""Mixing sources to target weights.

Documents get hash-random keys and are ranked by them within their source. The prefix sum of
their sizes says how many words of each the mix takes: whole epochs of a source first, then
documents in key order up to the exact budget, the last one in part.

The prefix sum is distributed: the leading hex digits of the key cut a source into ranges of
about equal size, sums of whole ranges are added up over the few ranges of a source, and only
the rows of one range are ever sorted together. A source with most rows is just as many ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursemill.llm.columns import WORD, aside, table, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
RANGE_DIGITS = 3  # 4,096 ranges per source


def targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
            epochs: int = EPOCHS) -> DataFrame:
    """Target words per source from (source, source_size): adds ``target``.

    Sources in code point order, null last, take the weights in turn. What a source cannot
    take, its target being at most ``epochs`` times its size, is shared out again by weight,
    until no target is above that. Ordered by size over weight, the sources that reach their
    limit are the first ones; the others get their weight times one common level.
    """
    everything = Window.partitionBy()
    by_name = everything.orderBy(F.col("source").isNull(), "source")
    by_need = everything.orderBy(F.col("_cap") / F.col("_weight"), "_place")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_need.rowsBetween(0, Window.unboundedFollowing)
    cycle = F.array(*[F.lit(w) for w in weights])
    rows = (
        totals
        .withColumn("_place", F.row_number().over(by_name))
        .withColumn("_weight", cycle[(F.col("_place") - 1) % len(weights)])
        .withColumn("_cap", F.col("source_size") * epochs)
        .withColumn("_rank", F.row_number().over(by_need))
        .withColumn("_level", (F.sum("source_size").over(everything) * F.lit(share)
                               - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
                    / F.sum("_weight").over(onwards))
        .withColumn("_open", F.col("_level") * F.col("_weight") < F.col("_cap"))
        .withColumn("_first", F.min(F.when(F.col("_open"), F.col("_rank"))).over(everything))
        .withColumn("_level", F.max(F.when(F.col("_rank") == F.col("_first"),
                                           F.col("_level"))).over(everything)))
    target = F.when(F.col("_rank") >= F.col("_first"), F.col("_level") * F.col("_weight"))
    return rows.select("source", "source_size",
                       F.coalesce(target, F.col("_cap").cast("double")).alias("target"))


def mix(docs: DataFrame, size: Column | None = None, source: str = "source",
        key: str = "doc_id", weights: Sequence[int] = WEIGHTS, share: float = SHARE,
        epochs: int = EPOCHS, digits: int = RANGE_DIGITS) -> DataFrame:
    """All rows with ``size``, ``source_size``, ``target`` and ``taken``.

    ``taken`` counts the words that the mix takes of a row, repeats included, so it is between
    0 and ``epochs`` times its size. The taken words of a source add up to its target, rounded
    down. Columns of the input with one of these four names are replaced; ``size`` is the
    expression of a row's size, the words of ``text`` by default. Null sizes count as 0, null
    sources are one source, sorted last. Repeated rows count each time; rows with equal keys
    stand in any order among themselves, and which one the cut falls on makes no difference if
    they are equal. An empty table gives no rows. Keys are MD5 of ``key``, so reruns agree.
    """
    size = word_count(F.col("text")) if size is None else size
    docs, back = aside(docs, "_source", "_key", "_range", "_of", "_in", "_start", "_before")
    rows = (
        docs
        .withColumn("size", F.coalesce(size.cast("long"), F.lit(0)))
        .withColumn("_source", F.col(source))
        .withColumn("_key", F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))))
        .withColumn("_range", F.substring("_key", 1, digits)))
    ranges = rows.groupBy("_source", "_range").agg(F.sum("size").alias("_sum"))
    totals = ranges.groupBy(F.col("_source").alias("source")).agg(
        F.sum("_sum").alias("source_size"))
    earlier = (Window.partitionBy("_source").orderBy("_range")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = ranges.select(
        F.col("_source").alias("_of"), F.col("_range").alias("_in"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    goal = targets(totals, weights, share, epochs)
    starts = starts.join(goal, F.col("_of").eqNullSafe(F.col("source"))).drop("source")
    within = (Window.partitionBy("_source", "_range").orderBy("_key", key, "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    budget = F.floor(F.col("target"))
    rest = budget % F.greatest(F.col("source_size"), F.lit(1))
    full = (budget - rest) / F.greatest(F.col("source_size"), F.lit(1))
    own = rows.drop("source_size", "target", "taken")
    return back(
        own
        .withColumn("_before", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(starts, F.col("_source").eqNullSafe(F.col("_of"))
              & (F.col("_range") == F.col("_in")))
        .withColumn("taken", (
            full * F.col("size")
            + F.greatest(F.lit(0), F.least(
                F.col("size"), rest - F.col("_start") - F.col("_before")))).cast("long"))
        .drop("_source", "_key", "_range", "_of", "_in", "_start", "_before"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: documents as often as it takes them, with the columns of ``docs``.

    Where the budget cuts a document, its first words as far as they are taken, joined by one
    space, are a row. ``n_chars`` follows. Documents of which no word is taken are left out.
    """
    row = {c: F.col(f"_row.`{c}`") for c in docs.columns}
    rows = mix(docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("_row")))
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    part = (F.col("taken") % F.col("size")).cast("int")
    rows = rows.where("taken > 0").select(
        "_row", F.explode(F.concat(
            F.array_repeat(F.lit(0), whole),
            F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>"))))
        .alias("_words"))
    cut = F.array_join(F.slice(F.regexp_extract_all(
        row["text"], F.lit(WORD), F.lit(0)), 1, F.greatest("_words", F.lit(1))), " ")
    text = F.when(F.col("_words") > 0, cut).otherwise(row["text"])
    out = row | {"text": text}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("_words") > 0, F.length(text).cast(
            docs.schema["n_chars"].dataType)).otherwise(row["n_chars"])
    return rows.select(*[value.alias(c) for c, value in out.items()])


def query(spark, folder):
    docs = table(spark, folder, "documents")
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix(rows, F.col("size")).select(
        "doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH docs AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
placed AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS place FROM totals),
weighed AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
         2 * source_size AS cap FROM placed),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, place) AS r,
         (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
          - coalesce(sum(cap) OVER (ORDER BY cap / w, place
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum(w) OVER (ORDER BY cap / w, place
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed),
first_open AS (
  SELECT r AS f, level AS common FROM ranked WHERE level * w < cap ORDER BY r LIMIT 1),
goals AS (
  SELECT source, source_size,
         CASE WHEN r >= f THEN common * w ELSE CAST(cap AS DOUBLE) END AS target
  FROM ranked LEFT JOIN first_open ON true),
cut AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         CAST(floor(g.target) AS BIGINT) AS budget,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST((budget // greatest(source_size, 1)) * size
            + greatest(0, least(size, budget % greatest(source_size, 1) - before)) AS BIGINT)
       AS taken
FROM cut
"""
