"""Quality rules: lines are cleaned first, then documents are judged by what is left.

DataFrame functions only, no shuffle: a document's lines and words are arrays of its own row.
Repeated word windows are found by sorting their 64-bit hashes within the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill.llm.columns import WORD, aside, table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 50
SHORT = 4  # words, under which a line needs an end mark

SYMBOLS = "[#*$%&|<>]"
END_MARK = r"[.!?:;…]['\x22)]*[\x20\x09-\x0D]*\z"
# Phrases of navigation and boilerplate, in lower case.
BOILERPLATE = (
    "all rights reserved|terms of use|terms of service|privacy policy|cookie|click here|"
    "read more|sign in|sign up|log in|subscribe|javascript|licensed under|copyright")


def _words(line: Column) -> Column:
    return F.regexp_count(line, F.lit(WORD))


def _symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))


def line_passes(line: Column) -> Column:
    """Whether a line with words is kept: it is neither loud (over a third of its words have
    doubled exclamation marks), nor navigation (over a third are symbols), nor a fragment
    (short, without an end mark), nor boilerplate."""
    words = _words(line)
    return ~((F.regexp_count(line, F.lit("!!")) * 3 > words)
             | (_symbols(line) * 3 > words)
             | ((words < SHORT) & ~line.rlike(END_MARK))
             | F.lower(line).rlike(BOILERPLATE))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with counts, verdicts and the cleaned text.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lost_words,
    base_failed, kept, cleaned. ``cleaned`` has the first of equal lines that pass. A null text
    counts as empty and is not kept. Rows are judged alone, so repeated rows get equal results;
    columns with the names of new ones are replaced, names beginning with ``_q_`` are kept apart.
    """
    docs, back = aside(docs, "_q_text", "_q_words", "_q_lines", "_q_firsts", "_q_good", "_q_windows",
                       "_q_sorted", "_q_starts")
    i3 = lambda i: F.xxhash64(*[F.get("_q_words", i + k) for k in range(3)])
    hash_at = lambda k: F.get("_q_sorted", k)["h"]
    rows = (
        docs
        .withColumn("_q_text", F.coalesce(F.col(text), F.lit("")))
        .withColumn("_q_words", F.regexp_extract_all("_q_text", F.lit(WORD), F.lit(0)))
        .withColumn("_q_lines", F.filter(F.split("_q_text", "\n", -1), lambda x: x.rlike(WORD)))
        .withColumn("_q_firsts", F.array_distinct("_q_lines"))
        .withColumn("_q_good", F.filter("_q_firsts", line_passes))
        .withColumn("_q_windows", F.when(F.size("_q_words") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("_q_words") - 3), i3))
            .otherwise(F.array().cast("array<long>")))
        .withColumn("_q_sorted", F.when(
            F.size(F.array_distinct("_q_windows")) < F.size("_q_windows"),
            F.sort_array(F.transform(
                "_q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
            .otherwise(F.array().cast("array<struct<h:long,i:int>>")))
        # Starts of windows that are found twice or more, in order.
        .withColumn("_q_starts", F.sort_array(F.transform(
            F.filter("_q_sorted", lambda s, k: F.coalesce(s["h"] == hash_at(k + 1), F.lit(False))
                     | ((k > 0) & (s["h"] == hash_at(F.greatest(k - 1, F.lit(0)))))),
            lambda s: s["i"])))
        .withColumn("n_words", F.size("_q_words").cast("long")))
    total = lambda values: F.aggregate(
        values, F.lit(0).cast("long"), lambda a, b: a + b.cast("long"))
    covered = F.transform("_q_starts", lambda s, k: F.least(
        F.lit(3), F.coalesce(F.get("_q_starts", k + 1) - s, F.lit(3))))
    return back(
        rows
        .withColumn("word_chars", F.length(
            F.regexp_replace("_q_text", r"[\x20\x09-\x0D]+", "")).cast("long"))
        .withColumn("n_symbols", _symbols(F.col("_q_text")).cast("long"))
        .withColumn("n_dup_lines", (F.size("_q_lines") - F.size("_q_firsts")).cast("long"))
        .withColumn("n_repeat_words", total(covered))
        .withColumn("n_lost_words",
                    F.col("n_words") - total(F.transform("_q_good", _words)))
        .withColumn("cleaned", F.array_join("_q_good", "\n"))
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
            F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))
        .withColumn("kept", ~F.col("base_failed") & (
            F.col("n_lost_words") * 100 <= F.col("n_words") * MAX_LOST_PERCENT))
        .drop("_q_text", "_q_words", "_q_lines", "_q_firsts", "_q_good", "_q_windows",
              "_q_sorted", "_q_starts"))


def query(spark, folder):
    return measure(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lost_words")


SQL = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text,
                     regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS three
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM docs)),
again AS (
  SELECT doc_id, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(3) AS r(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)),
                             lambda x: regexp_matches(x, '{WORD}')) AS l FROM docs),
good AS (
  SELECT doc_id, len(l) - len(list_distinct(l)) AS dups, coalesce(list_sum(list_transform(
    list_filter(list_distinct(l), lambda x: NOT (
      len(regexp_extract_all(x, '!!')) * 3 > len(regexp_extract_all(x, '{WORD}'))
      OR len(regexp_extract_all(x, '{SYMBOLS}')) * 3 > len(regexp_extract_all(x, '{WORD}'))
      OR (len(regexp_extract_all(x, '{WORD}')) < {SHORT}
          AND NOT regexp_matches(x, '{END_MARK.replace("'", "''")}'))
      OR regexp_matches(lower(x), '{BOILERPLATE}'))),
    lambda x: len(regexp_extract_all(x, '{WORD}')))), 0) AS left_words
  FROM lines),
counts AS (
  SELECT doc_id, len(words) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT)
           AS word_chars,
         len(regexp_extract_all(text, '{SYMBOLS}')) AS n_symbols, dups AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words,
         CAST(len(words) - left_words AS BIGINT) AS n_lost_words
  FROM docs JOIN good USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT}
         AS base_failed,
       NOT (n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT})
         AND n_lost_words * 100 <= n_words * {MAX_LOST_PERCENT} AS kept
FROM counts
"""
