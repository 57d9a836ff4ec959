"""Removal of repeated passages, found by recompression.

Texts are sequences of word names. Each round joins neighbouring symbols: equal ones (runs), and
pairs of which a hash of their names calls the left one left and the right one right. The new
symbol is named by a hash of the names it is made of, so equal passages get equal symbols
everywhere, but for the ends, where a symbol may depend on words outside. Every symbol carries
the words that it depends on, its context; a window of words knows the symbols whose context
lies within it, and among these an anchor: one of the highest round, of the least hash. Equal
windows have equal anchors, and an anchor is named with its context, several words.

1. Spark finds the anchors that more than one document has. Most text has none of them.
2. Only windows of a shared anchor are named (128 bits) and looked up in all documents.
3. A word is removed if a window over it also starts in a document of a smaller id.

Whole copies are settled ahead, by the name of the whole sequence. Each task first combines what
it has of a name: one row of a passage stays open and meets those of other tasks, the others
are settled and dealt out by their document. So a passage of all documents brings a row per task,
not per document, to one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill import session
from coursemill.llm.columns import table
from coursemill.operators.joins import spread_join

WINDOW = 13
ROUNDS = 2
CHUNK_BYTES = 6_000_000  # text that a task parses together

_FAR = 1 << 40
_ODD = np.random.default_rng(11).integers(1, 1 << 63, (2, 256), np.uint64) * 2 + 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Sequences:
    """The words of some texts, one after the other, as names."""

    def __init__(self, texts: list[bytes], window: int = WINDOW):
        import xxhash

        self.words = [text.split() for text in texts]
        self.sizes = np.array([len(words) for words in self.words], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.window = window
        of = xxhash.xxh64_intdigest
        self.names = np.fromiter((of(word) for words in self.words for word in words),
                                 np.uint64, int(self.sizes.sum()))
        self.text = np.repeat(np.arange(len(texts)), self.sizes)
        ends = np.repeat(self.starts + self.sizes, self.sizes)
        #: Whether a window starts at each word.
        self.whole = np.arange(len(self.names)) + window <= ends

    def keys(self, at: np.ndarray, which: int) -> np.ndarray:
        """Names of the windows that start at the given words; two kinds, 64 bits each."""
        total = np.zeros(len(at), np.uint64)
        for k in range(self.window):
            total += _mixed(self.names[at + k] ^ _ODD[which, 128 + k % 128]) * _ODD[which, k % 128]
        return _mixed(total)

    def rounds(self, count: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Symbols after each round: names, and their contexts as words [first, last)."""
        n = len(self.names)
        names, text = self.names, self.text
        first, last = np.arange(n), np.arange(1, n + 1)
        for number in range(count):
            if not len(names):
                return
            side = _mixed(names ^ _ODD[0, number]) >> np.uint64(63) == 0
            joined = ((names[1:] == names[:-1]) | (side[:-1] & ~side[1:])) & (
                text[1:] == text[:-1])
            begins = np.concatenate([[0], np.flatnonzero(~joined) + 1])
            sizes = np.diff(np.append(begins, len(names)))
            place = np.arange(len(names)) - np.repeat(begins, sizes)
            parts = _mixed(names + _mixed(place.astype(np.uint64) + _ODD[1, number]))
            merged = _mixed(np.add.reduceat(parts, begins) + sizes.astype(np.uint64))
            new = np.where(sizes > 1, merged, names[begins])
            ends = begins + sizes
            # A symbol depends on its neighbours; at the end of a text it depends on that.
            left, right = np.full(len(begins), -_FAR), np.full(len(begins), _FAR)
            inner = np.flatnonzero(begins > 0)
            inner = inner[text[begins[inner] - 1] == text[begins[inner]]]
            left[inner] = first[begins[inner] - 1]
            inner = np.flatnonzero(ends < len(names))
            inner = inner[text[ends[inner]] == text[begins[inner]]]
            right[inner] = last[ends[inner]]
            names, first, last, text = new, left, right, text[begins]
            yield names, first, last

    def anchors(self, rounds: int = ROUNDS) -> np.ndarray:
        """The name of the anchor of the window at each word: of its symbol with the context.

        A window that knows no symbol is its own. Undefined where no window starts.
        """
        n = len(self.names)
        begin, end = np.arange(n), np.arange(n) + self.window
        best, open_ = np.empty(n, np.uint64), self.whole.copy()
        for names, first, last in reversed(list(self.rounds(rounds))):
            best[:] = ~np.uint64(0)
            fits = np.flatnonzero(last - first <= self.window)
            first, last, rank = first[fits], last[fits], _mixed(names[fits])
            for k in range(self.window):
                at = last - self.window + k
                inside = at <= first
                if not inside.any():
                    break  # and at a later word neither
                own = np.flatnonzero(inside & (at >= 0))
                at = at[own]
                better = (rank[own] < best[at]) & open_[at]
                at, own = at[better], own[better]
                best[at], begin[at], end[at] = rank[own], first[own], last[own]
            open_ &= best == ~np.uint64(0)
        at = np.flatnonzero(self.whole)
        starts = _runs(begin[at], end[at])  # neighbours mostly share their anchor
        first, last = begin[at[starts]], end[at[starts]]
        total = (last - first).astype(np.uint64)
        for k in range(self.window):
            inside = np.flatnonzero(first + k < last)
            total[inside] += _mixed(self.names[first[inside] + k]) * _ODD[1, k % 128]
        found = np.zeros(n, np.uint64)
        found[at] = np.repeat(_mixed(total), np.diff(np.append(starts, len(at))))
        return found


def _chunks(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Batches put together and cut so that their texts hold about CHUNK_BYTES."""
    held, size = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(
            zero_copy_only=False).astype(np.int64)
        part = (size + np.cumsum(sizes)) // CHUNK_BYTES
        bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(bounds, bounds[1:], strict=False):
            if stop == start:
                continue
            if held and size + int(sizes[start:stop].sum()) > CHUNK_BYTES:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(batch.slice(start, stop - start))
            size += int(sizes[start:stop].sum())
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _rows_with(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pc.is_valid(batch.column(column)))


def _runs(*columns: np.ndarray) -> np.ndarray:
    """First rows of runs of equal values in sorted columns."""
    new = np.zeros(max(len(columns[0]) - 1, 0), bool)
    for column in columns:
        new |= column[1:] != column[:-1]
    return np.concatenate([[0], np.flatnonzero(new) + 1]) if len(columns[0]) else np.zeros(0, int)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _known_texts(batch: pa.RecordBatch) -> tuple[np.ndarray, list[bytes]]:
    ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return ids, [x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()]


# Rows that a task has settled by itself, and rows that wait for those of other tasks.
_SETTLED, _OPEN = 1, 0


def _anchor_rows(window: int, rounds: int):
    """(name, doc, state): anchors of documents. A name that several documents of the chunk have
    is settled for all of them, and shown twice to other chunks, so that they see it is shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(_rows_with(batches, 0), 1):
            ids, texts = _known_texts(batch)
            words = Sequences(texts, window)
            at = np.flatnonzero(words.whole)
            names, docs = words.anchors(rounds)[at], ids[words.text[at]]
            firsts = _runs(names, docs)  # neighbours mostly share their anchor
            names, docs = names[firsts], docs[firsts]
            order = np.lexsort((docs, names))
            names, docs = names[order], docs[order]
            firsts = _runs(names, docs)
            names, docs = names[firsts], docs[firsts]
            groups = _runs(names)
            many = np.diff(np.append(groups, len(names))) > 1
            shared = np.repeat(many, np.diff(np.append(groups, len(names))))
            shown = groups[many]
            state = np.where(shared, _SETTLED, _OPEN)
            yield pa.RecordBatch.from_arrays(
                [_signed(np.concatenate([names, names[shown], names[shown]])),
                 pa.array(np.concatenate([docs, docs[shown], docs[shown]])),
                 pa.array(np.concatenate([state, np.zeros(2 * len(shown), state.dtype)])
                          .astype(np.int8))],
                names=["name", "doc", "state"])

    return run


def _window_rows(window: int, rounds: int):
    """(one, two, doc, state): windows of shared anchors, from (doc_id, text, names). Of the
    documents of a chunk that have a window, all but the least are settled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(_rows_with(batches, 2), 1):
            ids, texts = _known_texts(batch)
            words = Sequences(texts, window)
            at = _of_lists(words, words.anchors(rounds), batch.column(2))
            one, two, docs = words.keys(at, 0), words.keys(at, 1), ids[words.text[at]]
            order = np.lexsort((docs, two, one))
            one, two, docs = one[order], two[order], docs[order]
            firsts = _runs(one, two, docs)
            one, two, docs = one[firsts], two[firsts], docs[firsts]
            state = np.full(len(one), _SETTLED, np.int8)
            state[_runs(one, two)] = _OPEN
            yield pa.RecordBatch.from_arrays(
                [_signed(one), _signed(two), pa.array(docs), pa.array(state)],
                names=["one", "two", "doc", "state"])

    return run


def _of_lists(words: Sequences, names: np.ndarray, lists: pa.ListArray) -> np.ndarray:
    """The window starts whose name is in their text's list."""
    at = np.flatnonzero(words.whole)
    values = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.uint64)
    with_owner = lambda v, o: v + _mixed(o + _ODD[1, 200])
    wanted = with_owner(values, owner)
    return at[np.isin(with_owner(names[at], words.text[at].astype(np.uint64)), wanted)]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, key) of rows (name, doc, state) sorted by name whose name has another open row."""
    rest = None

    def out(names, docs, state):
        firsts = _runs(names)
        sizes = np.diff(np.append(firsts, len(names)))
        opened = np.add.reduceat(state == _OPEN, firsts) if len(firsts) else np.zeros(0, int)
        kept = (state == _SETTLED) | (np.repeat(opened, sizes) > 1)
        return pa.RecordBatch.from_arrays([pa.array(docs[kept]), pa.array(names[kept])],
                                          names=["doc", "key"])

    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
        if not len(columns[0]):
            continue
        cut = int(_runs(columns[0])[-1])  # the last name may go on
        yield out(*[c[:cut] for c in columns])
        rest = [c[cut:] for c in columns]
    if rest is not None:
        yield out(*rest)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, key) of rows (one, two, doc, state) sorted so whose window a smaller doc has."""
    before = None
    for batch in batches:
        one, two, docs, state = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(one):
            continue
        new = np.zeros(len(one), bool)
        new[_runs(one, two)] = True
        # The first open row of a window is its least document; settled rows come after it.
        if before is not None and (one[0], two[0]) == before[:2]:
            new[0] = False
        least = np.where(new, docs, 0)
        runs = np.cumsum(new) - 1
        firsts = docs[np.flatnonzero(new)]
        least = np.where(runs >= 0, firsts[np.maximum(runs, 0)] if len(firsts) else 0,
                         before[2] if before is not None else 0)
        kept = (docs > least) | (state == _SETTLED)
        before = (one[-1], two[-1], least[-1])
        yield pa.RecordBatch.from_arrays([pa.array(docs[kept]), pa.array(one[kept])],
                                         names=["doc", "key"])


def _sequence_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [(x or b"").split() for x in batch.column(1).cast(pa.binary()).to_pylist()]
        names = [hashlib.md5(b" ".join(w)).digest() for w in words]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(w) for w in words], pa.int64()),
             pa.array(names, pa.binary())], names=["doc_id", "n_words", "name"])


LAYOUT = "doc_id long, n_words long, n_removed long, kept string"


def _cleaned(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches, 1):
            texts = [x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()]
            words = Sequences(texts, window)
            names = np.zeros(len(words.names), np.uint64)
            at = np.flatnonzero(words.whole)
            names[at] = words.keys(at, 0)
            change = np.zeros(len(words.names) + 1, np.int64)
            if len(at):
                starts = _of_lists(words, names, batch.column(2))
                np.add.at(change, starts, 1)
                np.add.at(change, starts + window, -1)
            gone = np.cumsum(change)[:-1] > 0
            # Whole copies of another document, if a window fits in them.
            copy = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            gone |= (copy & (words.sizes >= window))[words.text]
            kept, removed = [], []
            for k, own in enumerate(words.words):
                part = gone[words.starts[k]:words.starts[k] + len(own)]
                removed.append(int(part.sum()))
                kept.append(b" ".join([own[i] for i in np.flatnonzero(~part)]
                                      if removed[-1] else own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words.sizes), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; ``kept`` has the words that stay, joined
    by one space.

    Null texts have no words. A row without an id loses nothing and takes nothing from others.
    Rows of one id are one document for the others and take nothing from each other. Texts
    shorter than a window lose nothing. Other columns are left out.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = session.stored(docs.mapInArrow(
        _sequence_names, "doc_id long, n_words long, name binary"), "sequences")
    known = names.where("doc_id IS NOT NULL AND n_words > 0")
    firsts = known.groupBy("name").agg(F.min("doc_id").alias("first"))
    # Ids that are nothing but copies of documents of smaller ids.
    copies = session.stored(spread_join(known, firsts, "name", spread_by="doc_id").groupBy(
        F.col("doc_id").alias("copy_id")).agg(
        F.min(F.col("doc_id") != F.col("first")).alias("copy")).where("copy"), "copies")
    # All that is joined to texts is joined by id, and outer, so that texts are dealt out once.
    texts = docs.join(copies, F.col("doc_id") == F.col("copy_id"), "left")
    anchors = (
        texts.where("copy IS NULL").select("doc_id", "text")
        .mapInArrow(_anchor_rows(window, rounds), "name long, doc long, state byte")
        .repartition(_dealt("name")).sortWithinPartitions("name")
        .mapInArrow(_shared, "doc long, key long"))
    windows = (
        texts.join(_lists(anchors, "names"), F.col("doc_id") == F.col("names_of"), "left")
        .select("doc_id", "text", "names", "copy")  # the columns that the last step reads
        .mapInArrow(_window_rows(window, rounds), "one long, two long, doc long, state byte")
        .repartition(_dealt("one")).sortWithinPartitions("one", "two", "state", "doc")
        .mapInArrow(_repeated, "doc long, key long"))
    return (
        texts.join(_lists(windows, "keys"), F.col("doc_id") == F.col("keys_of"), "left")
        .select("doc_id", "text", F.coalesce("keys", F.array().cast("array<long>")).alias("keys"),
                F.coalesce("copy", F.lit(False)).alias("copy"))
        .mapInArrow(_cleaned(window), LAYOUT))


def _dealt(name: str) -> Column:
    """Rows of a name meet in one task, but for the settled ones, which need nothing from others."""
    return F.when(F.col("state") == _SETTLED, F.xxhash64(name, "doc")).otherwise(F.xxhash64(name))


def _lists(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy(F.col("doc").alias(f"{name}_of")).agg(F.collect_list("key").alias(name))


def query(spark, folder):
    return remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS sequence
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs)),
least AS (SELECT sequence, min(doc_id) AS first FROM windows GROUP BY sequence),
gone AS (
  SELECT DISTINCT doc_id, i + k AS place
  FROM windows JOIN least USING (sequence), range(13) AS r(k) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM docs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text
  FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
