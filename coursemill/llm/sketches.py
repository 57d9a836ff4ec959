"""Document fingerprints: every shingle hash below a fixed fraction of the hash range.

Such a sketch grows with its text, so the sketches of a short and a very long text can be
compared: of the shingles of the one, the share that the other has is estimated on the hashes
both could have kept. The sketch of two texts together is the union of theirs.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.llm.columns import table

SHINGLE = 5
# Three hashes in four are kept: fewer leave too little of short texts (see the README). They are
# of 32 bits, so the share of all that two texts of n shingles have in common by chance is n / 2**32.
FRACTION = 0.75
RANGE_BYTES = 32 << 20  # text of a range of ids, about
RANGES_A_PARTITION = 4  # at least

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def sketch(text: str, shingle: int = SHINGLE, fraction: float = FRACTION) -> np.ndarray:
    """Sorted distinct 32-bit hashes of a text's word shingles that are below the fraction.

    A text of fewer words has one shingle, a text without words none. The rule is the same for
    every text, so a text's sketch may be empty, and that of two texts together is the union.
    """
    import xxhash

    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint32)
    of = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width, count = min(shingle, len(of)), max(1, len(of) - shingle + 1)
    hashes = np.full(count, len(of) if width < shingle else shingle, np.uint64)
    for k in range(width):
        hashes = _mixed(hashes * _STEP + of[k:k + count])
    hashes = (hashes >> np.uint64(32)).astype(np.uint32)
    return np.unique(hashes[hashes < int(fraction * (1 << 32))])


def as_text(hashes: np.ndarray) -> str:
    """The hashes in ascending order, four bytes each, as Base64 text."""
    return base64.b64encode(hashes.astype(">u4").tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), ">u4").astype(np.uint32)


def merged(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.union1d(one, other)


def likeness(one: np.ndarray, other: np.ndarray) -> tuple[float, float]:
    """Share of the smaller sketch that the larger one has, and the share of all that both have.

    Two empty sketches are alike (1), an empty one and another are not (0).
    """
    if not len(one) or not len(other):
        alike = float(len(one) == len(other))
        return alike, alike
    both = len(np.intersect1d(one, other, assume_unique=True))
    return both / min(len(one), len(other)), both / (len(one) + len(other) - both)


def _in_ranges(docs: DataFrame) -> DataFrame:
    """(place, ahead, doc_id, tie, text): documents in ranges of ids, each with the one after it.

    Ranges go by descending id, and have about RANGE_BYTES of text however many there are; rows
    without an id come last, in ranges of their texts' hashes. ``ahead`` marks the rows a range
    shows of the next one, which for the last range is the first. What goes through the driver
    is two numbers per range.
    """
    spark = docs.sparkSession
    ids = docs.select("doc_id", "tie")
    sizes = docs.agg(F.sum(F.octet_length("text")).alias("all"),
                     F.sum(F.when(F.col("doc_id").isNull(), F.octet_length("text"))).alias("none")
                     ).first()
    ranges = max(RANGES_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")),
                 -(-(sizes["all"] or 0) // RANGE_BYTES))
    without = 1 + (sizes["none"] or 0) // RANGE_BYTES  # ranges of rows without an id
    bounds = ids.agg(F.percentile_approx(
        "doc_id", [k / ranges for k in range(1, ranges)], 10 * ranges)).first()[0] or []
    bounds = sorted(set(bounds))

    def places(of, ties):
        # The hash of a text, from the least to the greatest, falls into ranges of equal width.
        return [-1 - ((tie + (1 << 63)) * without >> 64) if i is None else bisect_right(bounds, i)
                for i, tie in zip(of, ties, strict=True)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = places(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()), *batch.columns], names=["place", "doc_id", "tie"])

    # The first row of a range has the greatest id, or without ids the least hash.
    firsts = (ids.mapInArrow(place, "place long, doc_id long, tie long").groupBy("place")
              .agg(F.max("doc_id").alias("first"), F.min("tie").alias("least"))
              .orderBy(F.desc("place")).collect())
    key = lambda row: (row.first, None if row.place >= 0 else row.least)
    before = {key(row): firsts[k - 1].place for k, row in enumerate(firsts)}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, ties = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            own = places(of, ties)
            keys = [(i, tie if i is None else None) for i, tie in zip(of, ties, strict=True)]
            shown = [k for k, row in enumerate(keys) if row in before]
            rows = batch.take(pa.array([*range(len(of)), *shown], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([*own, *[before[keys[k]] for k in shown]], pa.int64()),
                 pa.array([0] * len(of) + [1] * len(shown), pa.int32()), *rows.columns],
                names=["place", "ahead", "doc_id", "tie", "text"])

    rows = docs.mapInArrow(spread, "place long, ahead int, doc_id long, tie long, text string")
    return rows.repartition(int(ranges), "place")


LAYOUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double, "
          "jaccard_edited double, jaccard_next double")


def compare_with_edited(docs: DataFrame, shingle: int = SHINGLE,
                        fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of every text and of an edited one, whose last third is the next text's start.

    The last floor(n_chars / 3) code points are replaced by the first as many, or all, of the
    next document in descending order of doc_id; after the last comes the first. ``near_*`` is
    the containment of the smaller sketch, ``jaccard_*`` the resemblance. Null texts are empty.
    Rows without an id come last; rows of equal ids are ordered by the hash of their text. A
    single row is its own next one. Other columns are left out; an empty table gives no rows.
    """
    rows = _in_ranges(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"),
        F.coalesce("text", F.lit("")).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            out = []
            for place, ahead, doc, text in zip(
                    *[batch.column(k).to_pylist() for k in (0, 1, 2, 4)], strict=True):
                if ahead and (waiting is None or waiting[0] != place):
                    continue  # a second row shown of the next range
                new = sketch(text, shingle, fraction)
                if waiting is not None:
                    _, doc_before, before, own = waiting
                    cut = len(before) // 3
                    edited = before[:len(before) - cut] + text[:cut]
                    changed = sketch(edited, shingle, fraction)
                    near, jaccard = likeness(own, changed)
                    near_next, jaccard_next = likeness(own, new)
                    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((doc_before, len(before), sha, as_text(own), as_text(changed),
                                near, near_next, jaccard, jaccard_next))
                waiting = None if ahead else (place, doc, text, new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(
                    zip(*out, strict=True) if out else [[]] * 9,
                    [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 4],
                    strict=True)],
                names=[part.split()[0] for part in LAYOUT.split(", ")])

    return (rows.sortWithinPartitions("place", "ahead", F.desc_nulls_last("doc_id"), "tie")
            .mapInArrow(run, LAYOUT))


def query(spark, folder):
    return compare_with_edited(table(spark, folder, "documents"))
