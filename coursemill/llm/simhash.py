"""SimHash near-duplicates.

A fingerprint has a bit for each of 64, set if it is set in more than half the hashes of a text's
word shingles. Fingerprints that differ in few bits are linked, and linked documents form groups.

Links are found by the pigeonhole: cut into n blocks, two fingerprints that differ in at most d
bits agree on n - d blocks at least, so they meet under the key of one such choice of blocks.
Only distinct fingerprints take part, a copy being linked already. A key that many of them
share is cut into chunks, and each pair of chunks is one tile: the rows of a tile are bounded, all
pairs of the key are compared in some tile, and a tile yields a spanning forest of its links
rather than all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill import session
from coursemill.llm.columns import table
from coursemill.llm.links import components, firsts, kept_of

SHINGLE = 3
SEED = 42
DISTANCE = 3
BLOCKS = 5
TILE = 2048  # fingerprints of a key that meet in one tile, about


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    """Hashes of a text's word shingles; a text of fewer words has one, one without words none."""
    import xxhash

    words = text.lower().split()  # of bytes: A-Z alone, and the six white characters
    if not words:
        return []
    of = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return [of(b" ".join(words), SEED)]
    parts = zip(*[words[k:] for k in range(shingle)], strict=False)
    return [of(x, SEED) for x in map(b" ".join, parts)]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    hashes = shingle_hashes(text, shingle)
    if not hashes:
        return 0
    total, step = np.zeros(64, np.int64), 1 << 15
    for at in range(0, len(hashes), step):
        bits = np.unpackbits(np.array(hashes[at:at + step], ">u8").view(np.uint8).reshape(-1, 8),
                             axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE,
                 second: int | None = None) -> DataFrame:
    """The rows, less their text, with ``fingerprint`` and ``second`` as signed longs.

    ``second`` is the fingerprint of shingles of as many words, or 0. A text without words,
    empty or null, has 0. Columns of the new names are replaced.
    """
    new = ("fingerprint", "second")
    rows = docs.select(*[c for c in docs.columns if c not in (text, *new)], text)
    kept = rows.schema[:-1]
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() or b"" for x in batch.column(len(kept)).cast(pa.binary())]
            prints = [[fingerprint(x, words) if words else 0 for x in texts]
                      for words in (shingle, second)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1],
                 *[pa.array(np.array(p, np.uint64).view(np.int64)) for p in prints]],
                names=[*[f.name for f in kept], *new])

    return rows.mapInArrow(run, f"{layout}, fingerprint long, second long")


def _near(rows: np.ndarray, one, other, distance: int, second: int) -> np.ndarray:
    values, seconds = rows["value"], rows["second"]
    return (np.bitwise_count(values[one] ^ values[other]) <= distance) & (
        np.bitwise_count(seconds[one] ^ seconds[other]) <= second)


def _forest(rows: np.ndarray, distance: int, second: int) -> list[tuple[int, int]]:
    """Links (ids) that connect what is connected by pairs within the distances."""
    ids = rows["id"]
    found, left = [], np.arange(len(rows))
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            one = frontier.pop()
            near = _near(rows, left, one, distance, second)
            if near.any():
                found += [(ids[one], ids[x]) for x in left[near]]
                frontier += left[near].tolist()
                left = left[~near]
    return found


def _links_of_tiles(distance: int, second: int):
    """Links within runs of rows of equal (choice, key, tile), in sorted batches."""

    def links(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ids = rows["id"]
        cuts = np.flatnonzero(np.any([rows[c][1:] != rows[c][:-1] for c in
                                      ("choice", "key", "i", "j")], axis=0)) + 1
        starts = np.concatenate([[0], cuts]).astype(np.int64)
        sizes = np.diff(np.append(starts, len(rows)))
        small = np.repeat(sizes <= 16, sizes)
        ends = np.repeat(starts + sizes, sizes)
        for lag in range(1, 16):  # all pairs of small groups, a lag at a time
            first = np.flatnonzero(small & (np.arange(len(rows)) + lag < ends))
            if not len(first):
                break
            near = first[_near(rows, first, first + lag, distance, second)]
            yield ids[near], ids[near + lag]
        for start, size in zip(starts[sizes > 16], sizes[sizes > 16], strict=True):
            part = slice(start, start + size)
            pairs = _forest(rows[part], distance, second)
            if pairs:
                yield tuple(np.array(pairs, np.int64).T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        kinds = [("choice", "i4"), ("key", "i8"), ("i", "i4"), ("j", "i4"), ("value", "u8"),
                 ("second", "u8"), ("id", "i8")]

        def out(rows):
            pairs = list(links(rows)) if len(rows) > 1 else []
            if pairs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([p[k] for p in pairs])) for k in (0, 1)],
                    names=["a", "b"])

        for batch in batches:
            rows = np.empty(batch.num_rows, kinds)
            for name, kind in kinds:
                column = batch.column(batch.schema.get_field_index(name)).to_numpy(
                    zero_copy_only=False)
                rows[name] = column.view(np.uint64) if kind == "u8" else column
            rows = rows if rest is None else np.concatenate([rest, rows])
            if not len(rows):
                continue
            last = np.flatnonzero(np.any([rows[c] != rows[c][-1] for c in
                                          ("choice", "key", "i", "j")], axis=0))
            cut = last[-1] + 1 if len(last) else 0  # the last run may go on
            yield from out(rows[:cut])
            rest = rows[cut:]
        if rest is not None:
            yield from out(rest)

    return run


def links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS,
          tile: int = TILE, second_distance: int = 64) -> DataFrame:
    """Links (a, b) between the ids of distinct fingerprints (fingerprint, second, id).

    They connect whatever pairs within both distances connect; the result's components do not
    depend on ``blocks``, which is over ``distance``, or ``tile``.
    """
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = []
    for choice in combinations(range(blocks), blocks - distance):
        mask = sum((1 << edges[k + 1]) - (1 << edges[k]) for k in choice)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keyed = (
        prints
        .select(F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(m))
                                       for m in masks])).alias("choice", "key"),
                F.col("fingerprint").alias("value"), "second", "id"))
    sizes = (keyed.groupBy(F.col("choice").alias("c"), F.col("key").alias("k"))
             .agg(F.count("*").alias("size")).where("size > 1"))
    half = tile // 2
    tiled = (
        keyed.join(sizes, (F.col("choice") == F.col("c")) & (F.col("key") == F.col("k")))
        .withColumn("chunks", F.ceil(F.col("size") / half).cast("int"))
        .withColumn("chunk", F.pmod(F.xxhash64("value", "second"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.greatest(
            F.col("chunks") - 1, F.lit(0)))))
        # A pair of chunks is a tile; a chunk alone is one only where it is the key's only one.
        .where("chunks = 1 OR other != chunk")
        .select("choice", "key", F.least("chunk", "other").alias("i"),
                F.greatest("chunk", "other").alias("j"), "value", "second", "id"))
    return (tiled.repartition("choice", "key", "i", "j")
            .sortWithinPartitions("choice", "key", "i", "j", "value")
            .mapInArrow(_links_of_tiles(distance, second_distance), "a long, b long"))


def groups(docs: DataFrame, text: str = "text", distance: int = DISTANCE,
           shingle: int = SHINGLE, blocks: int = BLOCKS, tile: int = TILE,
           second: int | None = None, second_distance: int = 64) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    ``component_id`` is the least doc_id that can be reached over links, the row's own included.
    With ``second``, linked documents are also within ``second_distance`` by the fingerprints of
    shingles of so many words. Texts without words all have fingerprint 0 and are linked like
    any others. Rows without a doc_id are linked too, but name no component; one of such rows
    alone is null. Repeated rows give repeated results. Other columns are left out.
    """
    # The node of a fingerprint is its bit pattern, or a hash of both patterns.
    node = F.xxhash64("fingerprint", "second") if second else F.col("fingerprint")
    prints = session.stored(fingerprints(
        docs.select("doc_id", text), text, shingle, second).withColumn("id", node), "fingerprints")
    distinct = prints.groupBy("fingerprint", "second", "id").agg(F.min("doc_id").alias("first"))
    nodes = components(links(distinct, distance, blocks, tile, second_distance))
    return (prints.join(firsts(distinct, nodes), F.col("id") == F.col("of_id"))
            .select("doc_id", "fingerprint", F.col("least").alias("component_id")))


def representatives(docs: DataFrame, **options: int) -> DataFrame:
    """The documents less near-duplicates: of each group the one with the least doc_id stays.

    ``options`` are those of :func:`groups`. All rows of a kept doc_id stay. Rows without a
    doc_id cannot be told apart by id: all of them stay if one has no row with an id in its group.
    """
    return kept_of(docs, groups(docs, **options))


def query(spark, folder):
    return groups(table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id")
