"""Packing documents into sequences: best fit, longest pieces first.

A document is encoded and cut into full windows and a rest. Pieces are dealt to shards by a hash;
each shard packs its own, sorted by falling length, into the open sequence with the least room
that still fits. A segment tree over the possible room finds that sequence in 12 steps. A
shard's sequences are its own, so no task sees more than its shard, and what a shard loses is
its last few open sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.llm import encoding
from coursemill.llm.columns import table

WINDOW = 2048
SEQUENCES_PER_SHARD = 40  # bits


def pieces(docs: DataFrame, path: str, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]) of every text, cut into windows.

    A null text is an empty one and has the end id alone. Repeated rows each give their pieces.
    Other columns are left out. An empty table gives no rows.
    """
    layout = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in encoding.chunks(batches):
            values, bounds = encoding.encoded(batch, path)
            sizes = np.diff(bounds)
            parts = -(-sizes // window)
            of = np.repeat(np.arange(len(sizes)), parts)
            first = np.cumsum(parts) - parts
            start = (np.arange(len(of)) - first[of]) * window
            length = np.minimum(window, sizes[of] - start)
            cut = np.append(bounds[of] + start, len(values))  # pieces are gapless
            columns = [
                batch.column(0).take(pa.array(of)), pa.array(start), pa.array(length),
                pa.array(np.array([zlib.crc32(values[a:b]) for a, b in zip(
                    cut, cut[1:], strict=False)], np.int64)),
                pa.array(sizes[of])]
            if with_ids:
                columns.append(encoding.id_lists(encoding.cutting.Ragged(values, cut)))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, layout + ", ids array<int>" * with_ids))


class Room:
    """Open sequences by the room they have left; a segment tree over the amounts of room."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.filled = bytearray(2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        node = self.leaves + room
        while node and not self.filled[node]:
            self.filled[node] = 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The sequence with the least room of at least ``length``, and that room."""
        filled, node = self.filled, self.leaves + length
        if not filled[node]:
            while node > 1 and (node & 1 or not filled[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if filled[2 * node] else 2 * node + 1
        room = node - self.leaves
        sequence = self.open[room].pop()
        if not self.open[room]:
            filled[node] = 0
            node >>= 1
            while node and not (filled[2 * node] or filled[2 * node + 1]):
                filled[node] = 0
                node >>= 1
        return sequence, room


def pack(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of (doc_id, start, length, ...) with ``sequence_id`` and ``offset``.

    ``length`` is between 1 and ``window``. Within a sequence offsets are gapless from 0. All
    columns of ``rows`` are kept, but for two with the names of the new ones. Rows that are
    equal are packed one by one.
    """
    rows = rows.drop("sequence_id", "offset")
    names = [f.name for f in rows.schema]
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    at = names.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << SEQUENCES_PER_SHARD
        room, made = Room(window), 0
        for batch in batches:
            ids, offsets = [], []
            for length in batch.column(at).to_pylist():
                found = room.take(length)
                if found is None:
                    found = made, window
                    made += 1
                sequence, left = found
                ids.append(first + sequence)
                offsets.append(window - left)
                if left > length:
                    room.put(left - length, sequence)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.int64()), pa.array(offsets, pa.int64())],
                names=[*names, "sequence_id", "offset"])

    return (rows.repartition(F.xxhash64("doc_id", "start"))
            .sortWithinPartitions(F.desc("length"), "doc_id", "start")
            .mapInArrow(run, f"{layout}, sequence_id long, offset long"))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of packed pieces that hold their ids: the rows to train on.

    A sequence is one group of at most a window of ids.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def query(spark, folder):
    import public_tokenizers

    docs = table(spark, folder, "documents")
    return pack(pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False))
