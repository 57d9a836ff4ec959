"""Alignment of two tokenizers by inverted pair bitmaps.

The byte offsets at which tokens of both vocabularies end cut a text into groups; the tokens of
a group are linked with each other. A pair of ids has a bitmap of the documents that hold it
linked: documents are numbered within blocks, and a block's documents of a pair are one container,
a sorted list of 16-bit numbers or, if that is longer, bits. Planes hold the multiplicities: plane
0 has the documents, plane k + 1 those whose number of links less one has bit k set. Containers
of a block are OR-merged where they are made, and their sizes add up to the pair's number of
documents. The same postings then return what the counts say of each document.

A pair may be in every block, so the postings of a pair are joined by spans of 256 input tasks
rather than under one key, and its counts are repeated per span.

Both tokenizers are run on distinct pieces (`pieces`), at whose borders tokens of both end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill import session
from coursemill.llm import encoding
from coursemill.llm import pieces as cutting
from coursemill.llm.columns import table

KEPT = 150_000  # pieces of either sort that a worker keeps
BLOCK = 8192  # documents of a block at most; a container of bits has as many
BLOCK_LINKS = 3_000_000  # links after which a block is closed
MANY = 1 << 16  # links of a group that are counted rather than listed
ID_BITS = 20
SPACE = "▁"
OPTIONS = {"compression": "zstd"}

LAYOUT = ("block long, plane int, a int, b int, n int, docs binary, place int, doc_id long, "
          "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string")


class Aligned(NamedTuple):
    """What is known of a piece."""

    sizes: tuple[int, int, int]  # tokens of both kinds, and groups
    groups: bytes  # as text, with ";" behind each group
    links: bytes  # pairs, as a << ID_BITS | b, once per link
    counted: tuple[np.ndarray, np.ndarray] | None = None  # pairs of large groups, and links
    whole: bool = True  # whether its tokens join to it again


NOTHING = Aligned((0, 0, 0), b"", b"")


def _bytes_of_level(name: str) -> bytes | None:
    """Bytes of an entry of a byte-level vocabulary, whose letters stand for bytes."""
    if not _LETTERS:
        # Printable Latin letters stand for themselves, the others for the code points from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [byte for byte in range(256) if byte not in plain]
        _LETTERS.update({chr(byte): byte for byte in plain})
        _LETTERS.update({chr(256 + k): byte for k, byte in enumerate(rest)})
    try:
        return bytes([_LETTERS[letter] for letter in name])
    except KeyError:
        return None


_LETTERS: dict[str, int] = {}


class Aligner:
    """Both tokenizers of a worker. ``byte_path``: a byte-level BPE, ``piece_path``: a
    sentencepiece model that puts a space ahead of a text."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece

        self.one = encoding.Encoder(byte_path, plain=True, kept=KEPT // 2)
        self.two = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        tokenizer = self.one.tokenizer
        self.one_bytes = [_bytes_of_level(tokenizer.id_to_token(k) or "") or b""
                          for k in range(tokenizer.get_vocab_size())]
        self.two_bytes = []
        for k in range(self.two.get_piece_size()):
            name = self.two.id_to_piece(k)
            self.two_bytes.append(
                bytes([int(name[3:5], 16)]) if self.two.is_byte(k) else
                b"" if self.two.is_control(k) or self.two.is_unknown(k) else
                name.replace(SPACE, " ").encode())
        self.one_sizes = np.array([len(x) for x in self.one_bytes], np.int64)
        self.two_sizes = np.array([len(x) for x in self.two_bytes], np.int64)
        self.pieces = cutting.Kept(self._look_up, KEPT)  # what is known of each piece

    def _look_up(self, words: list[str]) -> list[Aligned]:
        ones = [np.frombuffer(ids, "<u4") for ids in self.one.runs(words)]
        texts = [cutting.raw(word) for word in words]
        # The model puts the space ahead of a piece itself.
        twos = self.two.encode([text[1:] for text in texts], num_threads=1)
        good, out = [], [NOTHING] * len(words)
        for k, text in enumerate(texts):
            want = text.encode()
            if (text.startswith(" ")
                    and b"".join([self.one_bytes[i] for i in ones[k].tolist()]) == want
                    and b"".join([self.two_bytes[i] for i in twos[k]]) == want):
                good.append(k)
            elif text:  # an empty one stands ahead of a text whose space is in the next one
                out[k] = NOTHING._replace(whole=False)
        for at in range(0, len(good), 20_000):
            some = good[at:at + 20_000]
            found = self._align([ones[k] for k in some], [np.array(twos[k]) for k in some])
            for k, aligned in zip(some, found, strict=True):
                out[k] = aligned
        return out

    def _align(self, ones: list[np.ndarray], twos: list[np.ndarray]) -> Iterator[Aligned]:
        """Pieces whose tokens are given, and have the same bytes."""
        a, b = (np.concatenate(x).astype(np.int64) for x in (ones, twos))
        ends_a, ends_b = np.cumsum(self.one_sizes[a]), np.cumsum(self.two_sizes[b])
        cuts = np.intersect1d(ends_a, ends_b)  # with the ends of all pieces, whose bytes agree
        last_a = np.searchsorted(ends_a, cuts, "right")  # tokens up to the end of each group
        last_b = np.searchsorted(ends_b, cuts, "right")
        first_a, first_b = np.append(0, last_a[:-1]), np.append(0, last_b[:-1])
        size_a, size_b = last_a - first_a, last_b - first_b
        large = size_a * size_b > MANY
        # Each token of the first kind meets all of the second kind in its group.
        group = np.repeat(np.arange(len(cuts)), size_a)
        meets = np.where(large, 0, size_b)[group]
        ends = np.cumsum(meets)
        other = np.arange(ends[-1]) + np.repeat(first_b[group] - (ends - meets), meets)
        links = np.repeat(a, meets) << ID_BITS | b[other]
        before = np.append(0, ends)
        piece_a = np.cumsum([len(x) for x in ones])
        group_of = np.searchsorted(last_a, piece_a, "left") + 1  # groups up to each piece's end
        names_a, names_b = a.astype(str).tolist(), b.astype(str).tolist()
        runs = [",".join(names_a[i:j]) + "|" + ",".join(names_b[k:m]) + ";" for i, j, k, m in zip(
            first_a.tolist(), last_a.tolist(), first_b.tolist(), last_b.tolist(), strict=True)]
        at = at_group = 0
        many = set(np.flatnonzero(large).tolist())
        for one, two, stop, stop_group in zip(
                ones, twos, piece_a.tolist(), group_of.tolist(), strict=True):
            counted = None
            if many:
                parts = [self._counted(a[first_a[g]:last_a[g]], b[first_b[g]:last_b[g]])
                         for g in range(at_group, stop_group) if g in many]
                if parts:
                    counted = (np.concatenate([p for p, _ in parts]),
                               np.concatenate([c for _, c in parts]))
            yield Aligned(
                (len(one), len(two), stop_group - at_group),
                "".join(runs[at_group:stop_group]).encode(),
                links[before[at]:before[stop]].tobytes(), counted)
            at, at_group = stop, stop_group

    @staticmethod
    def _counted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one, of_one = np.unique(a, return_counts=True)
        two, of_two = np.unique(b, return_counts=True)
        return ((one[:, None] << ID_BITS | two[None, :]).ravel(),
                (of_one[:, None] * of_two[None, :]).ravel())


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    if (byte_path, piece_path) not in _aligners:
        _aligners[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return _aligners[byte_path, piece_path]


class _Block:
    """Documents of a block and their links, until it is written."""

    def __init__(self, number: int):
        self.number, self.docs, self.links = number, 0, 0
        self.rows: list[list] = []
        self.keys: list[np.ndarray] = []  # link and document, once per link
        self.counted: list[tuple[np.ndarray, np.ndarray]] = []

    def postings(self) -> pa.RecordBatch:
        """(a, b, plane) with a container each; equal keys of the block are merged."""
        keys = np.sort(np.concatenate(self.keys or [np.empty(0, np.int64)]))
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        keys, counts = keys[first], np.diff(np.append(first, len(keys)))
        if self.counted:
            keys = np.concatenate([keys, *[k for k, _ in self.counted]])
            counts = np.concatenate([counts, *[c for _, c in self.counted]])
            keys, of = np.unique(keys, return_inverse=True)
            counts = np.bincount(of, counts, len(keys)).astype(np.int64)
        # Planes of the links beyond the first of each document.
        planes = [(keys, 0)]
        more, extra, bit = keys[counts > 1], counts[counts > 1] - 1, 0
        while len(more):
            planes.append((more[extra >> bit & 1 == 1], bit + 1))
            more, extra = more[extra >> bit > 1], extra[extra >> bit > 1]
            bit += 1
        columns = [self._containers(some, plane) for some, plane in planes]
        return pa.Table.from_batches(columns).combine_chunks().to_batches()

    def _containers(self, keys: np.ndarray, plane: int) -> pa.RecordBatch:
        pair, doc = keys // BLOCK, (keys % BLOCK).astype(np.uint16)
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        n = np.diff(np.append(first, len(pair)))
        pair = pair[first]
        words = np.minimum(n, BLOCK // 16)  # 16-bit numbers of a container
        begin = np.cumsum(words) - words
        data = np.zeros(int(words.sum()), "<u2")
        listed = np.repeat(n < BLOCK // 16, n)
        of = np.repeat(np.arange(len(n)), n)
        rank = np.arange(len(doc)) - first[of]
        data[begin[of[listed]] + rank[listed]] = doc[listed]
        bits = ~listed
        np.bitwise_or.at(data, begin[of[bits]] + (doc[bits] >> 4),
                         np.uint16(1) << (doc[bits] & 15))
        offsets = np.append(2 * begin, 2 * len(data)).astype(np.int32)
        docs = pa.BinaryArray.from_buffers(
            pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), self.number)), pa.array(np.full(len(n), plane, np.int32)),
             pa.array((pair >> ID_BITS).astype(np.int32)),
             pa.array((pair & ((1 << ID_BITS) - 1)).astype(np.int32)),
             pa.array(n.astype(np.int32)), docs],
            names=["block", "plane", "a", "b", "n", "docs"])


def documents_of(docs: bytes, n: int) -> np.ndarray:
    """The documents of a container."""
    if n < BLOCK // 16:
        return np.frombuffer(docs, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(docs, np.uint8), bitorder="little"))


def postings(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Rows of two kinds: containers (block, plane, a, b, n, docs), and documents.

    A document's row has plane -1, its ``place`` in the block, its id, and the number of its
    tokens, groups and links, and the digest of its groups. A text that is null or
    empty, or that the tokens do not join to again, has none. Repeated rows are
    documents of their own. Other columns are left out.
    """
    names = [part.split()[0] for part in LAYOUT.split(", ")]
    schema = pa.schema([
        ("block", pa.int64()), ("plane", pa.int32()), ("a", pa.int32()), ("b", pa.int32()),
        ("n", pa.int32()), ("docs", pa.binary()), ("place", pa.int32()), ("doc_id", pa.int64()),
        *[(name, pa.int64()) for name in names[8:12]], ("groups_sha256", pa.string())])

    def filled(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [batch.column(f.name) if f.name in batch.schema.names
                   else pa.nulls(batch.num_rows, f.type) for f in schema]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def chunk(batch: pa.RecordBatch, made: Aligner) -> Iterator[tuple]:
        """Per document its numbers and its links."""
        texts = batch.column(1).to_pylist()
        words, of, bounds = cutting.cut(pa.array([" " + t if t else "" for t in texts]))
        known = made.pieces(words)
        good = np.array([k.whole for k in known], bool)
        cut = cutting.Pieces(words, of, bounds)
        sizes = np.array([k.sizes for k in known], np.int64).reshape(-1, 3)
        sizes = [cutting.sums(sizes[:, k], cut) for k in range(3)]
        whole = (cutting.sums((~good).astype(np.int64), cut) == 0) & np.array(
            [bool(t) for t in texts], bool)
        links = cutting.spread(cutting.ragged([k.links for k in known], "<i8"), of, bounds)
        groups = [k.groups for k in known]
        counted = {k: x.counted for k, x in enumerate(known) if x.counted}
        ids = batch.column(0).to_pylist()
        for row, doc in enumerate(ids):
            if not whole[row]:
                yield doc, (0, 0, 0), "", np.empty(0, np.int64), []
                continue
            own = of[bounds[row]:bounds[row + 1]].tolist()
            text = b"".join([groups[k] for k in own])[:-1]
            yield (doc, tuple(int(s[row]) for s in sizes), hashlib.sha256(text).hexdigest(),
                   links.values[links.bounds[row]:links.bounds[row + 1]],
                   [counted[k] for k in own if k in counted] if counted else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, first = aligner(byte_path, piece_path), TaskContext.get().partitionId() << 32
        block = _Block(first)

        def closed() -> Iterator[pa.RecordBatch]:
            yield filled(pa.RecordBatch.from_pylist([
                dict(zip(["block", "plane", "place", *names[7:]], row, strict=True))
                for row in block.rows], schema=pa.schema([
                    f for f in schema if f.name not in ("a", "b", "n", "docs")])))
            for batch in block.postings():
                for at in range(0, batch.num_rows, 20_000):
                    yield filled(batch.slice(at, 20_000))

        for batch in encoding.chunks(batches):
            for doc, sizes, digest, links, counted in chunk(batch, made):
                n_links = len(links) + sum(int(c.sum()) for _, c in counted)
                block.rows.append([block.number, -1, block.docs, doc, *sizes, n_links, digest])
                block.keys.append(links * BLOCK + block.docs)
                block.counted += [(k * BLOCK + block.docs, c) for k, c in counted]
                block.docs += 1
                block.links += len(links)
                if block.docs == BLOCK or block.links > BLOCK_LINKS:
                    yield from closed()
                    block = _Block(block.number + 1)
        if block.docs:
            yield from closed()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, LAYOUT)


def _weight() -> Column:
    """Links that a document of a plane stands for."""
    return F.when(F.col("plane") == 0, 1).otherwise(
        F.pow(F.lit(2), F.col("plane") - 1)).cast("long")


def counts(rows: DataFrame) -> DataFrame:
    """(a, b, count, n_links, top): documents and links of each pair, and the highest count of
    any pair with the same ``a``."""
    pairs = rows.where("plane >= 0").groupBy("a", "b").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n"))).alias("count"),
        F.sum(F.col("n").cast("long") * _weight()).alias("n_links"))
    top = pairs.groupBy(F.col("a").alias("of")).agg(F.max("count").alias("top"))
    return pairs.join(top, F.col("a") == F.col("of")).drop("of")


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per document from postings with the counts of their pairs, sorted by block."""
    block, sums = None, np.zeros((2, BLOCK), np.int64)

    def out():
        places = np.flatnonzero(sums[1])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(places), block)), pa.array(places.astype(np.int32)),
             pa.array(sums[0][places]), pa.array(sums[1][places])],
            names=["block", "place", "n_best", "count_sum"])

    for batch in batches:
        blocks = batch.column(0).to_numpy()
        weight = batch.column(1).to_numpy()
        best, count = (batch.column(k).to_numpy().astype(np.int64) for k in (2, 3))
        n = batch.column(4).to_numpy().astype(np.int64)
        docs = batch.column(5)
        if isinstance(docs, pa.ChunkedArray):
            docs = docs.combine_chunks()
        offsets = np.frombuffer(docs.buffers()[1], np.int32)[
            docs.offset:docs.offset + len(docs) + 1]
        data = np.frombuffer(docs.buffers()[2], np.uint8)
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if blocks[a] != block:
                if block is not None:
                    yield out()
                block, sums = int(blocks[a]), np.zeros((2, BLOCK), np.int64)
            listed = np.flatnonzero(n[a:b] < BLOCK // 16) + a
            if len(listed) == b - a:
                places = np.frombuffer(data[offsets[a]:offsets[b]].tobytes(), "<u2")
            else:
                places = np.frombuffer(b"".join(
                    [data[offsets[k]:offsets[k + 1]].tobytes() for k in listed]), "<u2")
            for k, values in enumerate((best, count)):
                # Sums of whole numbers below 2**53 are exact.
                sums[k] += np.bincount(places, np.repeat((values * weight)[listed], n[listed]),
                                       BLOCK).astype(np.int64)
            for row in np.flatnonzero(n[a:b] >= BLOCK // 16) + a:
                own = documents_of(data[offsets[row]:offsets[row + 1]].tobytes(), n[row])
                sums[0][own] += best[row] * weight[row]
                sums[1][own] += count[row] * weight[row]
    if block is not None:
        yield out()


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    folder = session.work_folder(docs.sparkSession, "postings")
    postings(docs, byte_path, piece_path).write.options(**OPTIONS).parquet(folder)
    rows = docs.sparkSession.read.schema(LAYOUT).parquet(folder)
    found = rows.where("plane >= 0").select(
        "block", "plane", "a", "b", "n", "docs",
        F.floor(F.shiftright("block", 32) / 256).cast("int").alias("span"))
    scored = session.stored(counts(rows).select(
        F.col("a").alias("one"), F.col("b").alias("two"), "count",
        (F.col("count") == F.col("top")).cast("int").alias("best")), "pair-counts")
    spans = found.where("plane = 0").groupBy("a", "b", "span").agg(F.lit(1).alias("x")).drop("x")
    scored = spans.join(scored, (F.col("a") == F.col("one")) & (F.col("b") == F.col("two"))).select(
        "one", "two", F.col("span").alias("own"), "count", "best")
    returned = found.join(scored, (F.col("a") == F.col("one")) & (F.col("b") == F.col("two")) & (
        F.col("span") == F.col("own"))).select(
        "block", _weight().alias("weight"),
        "best", "count", "n", "docs")
    sums = (returned.repartition("block").sortWithinPartitions("block")
            .mapInArrow(_scores, "block long, place int, n_best long, count_sum long"))
    sums = sums.select(F.col("block").alias("_block"), F.col("place").alias("_place"), "n_best",
                       "count_sum")
    return rows.where("plane = -1").join(
        sums, (F.col("block") == F.col("_block")) & (F.col("place") == F.col("_place")),
        "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")


def query(spark, folder):
    import public_tokenizers

    return align(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model"))
