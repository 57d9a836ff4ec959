"""Token ids of whole texts, with the ids of words kept between texts.

A batch is cut into pieces, each distinct piece is encoded once, and its ids are spread over its
places (`pieces`). What is kept is bounded; the ids equal those of encoding the text in one
call (`tests/llm/test_encoding.py`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from coursemill.llm import pieces as cutting

END_ID = 1
KEPT_PIECES = 450_000  # pieces of either sort that a worker keeps, about 200 MB in all
WORDS_A_CALL = 128  # words that are encoded as one text
CHUNK_CHARS = 4_000_000  # characters that are encoded together

# Pieces that fall into words and marks, which no vocabulary entry joins.
_PARTS = (r"^(?P<word> ?[\pL\pN]+)(?P<mark>[.,]?)"
          r"(?:(?P<line>\n)(?P<after>[\pL\pN]+)(?P<last>[.,]?))?$")

_encoders: dict[tuple[str, bool], Encoder] = {}


class Encoder:
    """Ids as little-endian unsigned 32-bit integers.

    With ``plain``, the strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False, kept: int = KEPT_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.runs = cutting.Kept(self._look_up, kept)  # ids of each piece
        # Vocabularies mark the last token of a word, or the first one after a space.
        size = self.tokenizer.get_vocab_size()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        last = np.array([name.endswith("</w>") for name in names])
        first = np.array([name.startswith("\u0120") for name in names])
        self.marks, self.mark_is_last = (last, True) if last.any() else (first, False)

    def _encoded(self, words: list[str], others: list[str]) -> dict[str, bytes]:
        """Words, which are letters alone, are encoded some at a time, and cut apart at the marks
        of the vocabulary; other pieces one by one."""
        found = {}
        for start in range(0, len(words), 160 * WORDS_A_CALL):
            groups = [words[at:at + WORDS_A_CALL] for at in range(
                start, min(start + 160 * WORDS_A_CALL, len(words)), WORDS_A_CALL)]
            encoded = self.tokenizer.encode_batch_fast(
                [" " + " ".join(group) for group in groups], add_special_tokens=False)
            for group, x in zip(groups, encoded, strict=True):
                ids = np.array(x.ids, "<u4")
                marked = np.flatnonzero(self.marks[ids])
                if len(marked) != len(group):  # a letter whose lower case is more than letters
                    others = others + group
                    continue
                ids, cuts = ids.tobytes(), (4 * marked).tolist()
                cuts = [0, *[x + 4 for x in cuts]] if self.mark_is_last else [*cuts, len(ids)]
                found.update(zip(group, [ids[i:j] for i, j in zip(cuts, cuts[1:], strict=False)],
                                 strict=False))
        for start in range(0, len(others), 20_000):
            some = others[start:start + 20_000]
            found.update(zip(some, [
                np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(
                    [cutting.raw(piece) for piece in some], add_special_tokens=False)],
                strict=True))
        return found

    def _look_up(self, new: list[str]) -> list[bytes]:
        """Ids of pieces."""
        alpha = list(map(str.isalpha, new))
        found = self._encoded([word for word, is_word in zip(new, alpha, strict=True) if is_word],
                              [word for word, is_word in zip(new, alpha, strict=True) if not is_word])
        return list(map(found.__getitem__, new))

    def ids(self, texts: pa.Array, end: int | None = None) -> cutting.Ragged:
        """Ids of each text, and ``end`` after them if it is given."""
        words, of, bounds = cutting.cut(texts, as_list=False)
        parts, part_of, part_bounds = _parts(words)
        pieces = cutting.spread(cutting.ragged(self.runs(parts), "<u4"), part_of, part_bounds)
        if end is not None:  # one more piece at the end of each text
            pieces = cutting.Ragged(np.append(pieces.values, np.array([end], "<u4")),
                                    np.append(pieces.bounds, len(pieces.values) + 1))
            of = np.insert(of, bounds[1:], len(words))
            bounds = bounds + np.arange(len(bounds))
        return cutting.spread(pieces, of, bounds)


def _parts(words: pa.Array) -> cutting.Pieces:
    """Pieces as the words and marks that they are made of, where no vocabulary entry joins them."""
    rows = np.flatnonzero(~np.asarray(pc.utf8_is_alnum(words)))
    some = words.take(pa.array(rows))
    # Most others are a word and one mark; patterns are slow, and left to the rest.
    ahead = pc.binary_slice(some.cast(pa.binary()), 0, -1)
    marked = np.asarray(pc.or_(pc.ends_with(some, "."), pc.ends_with(some, ",")))
    marked &= np.asarray(pc.utf8_is_alnum(pc.if_else(pa.array(marked), ahead, b"").cast(pa.string())))
    marks = pc.binary_slice(some.cast(pa.binary()), -1)
    found = pc.extract_regex(some.filter(pa.array(~marked)), _PARTS)
    left, whole = rows[~marked], np.asarray(pc.is_null(found))
    plain = np.ones(len(words), bool)
    plain[rows[marked]] = plain[left[~whole]] = False

    def part(rows, number, strings):
        """Parts of pieces; but for the first, they have no space ahead."""
        own = np.asarray(pc.greater(pc.binary_length(strings), 0))
        if number:
            strings = pc.binary_join_element_wise(" ", strings, "")
        return rows[own] * 5 + number, strings.filter(pa.array(own))

    cut = pa.array(~whole)
    parts = [part(np.flatnonzero(plain), 0, words.filter(pa.array(plain))),
             part(rows[marked], 0, ahead.filter(pa.array(marked)).cast(pa.string())),
             part(rows[marked], 1, marks.filter(pa.array(marked)).cast(pa.string())),
             *[part(left[~whole], k, pc.struct_field(found, name).filter(cut))
               for k, name in enumerate(("word", "mark", "line", "after", "last"))]]
    place = np.concatenate([p for p, _ in parts])
    order = np.argsort(place, kind="stable")
    coded = pa.concat_arrays([strings for _, strings in parts]).dictionary_encode()
    bounds = np.searchsorted(place[order] // 5, np.arange(len(words) + 1))
    return cutting.Pieces(cutting.listed(coded.dictionary),
                          coded.indices.to_numpy().astype(np.int64)[order], bounds)


def encoder(path: str, plain: bool = False) -> Encoder:
    """The worker's encoder for a vocabulary file, made once."""
    if (path, plain) not in _encoders:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        _encoders[path, plain] = Encoder(path, plain)
    return _encoders[path, plain]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of one hold about CHUNK_CHARS characters, or are one text."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.nan_to_num(np.asarray(
            pc.binary_length(column).to_pandas(), dtype=float)).astype(np.int64)
        part = np.cumsum(sizes) // CHUNK_CHARS
        bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(bounds, bounds[1:], strict=False):
            if stop > start:
                yield batch.slice(start, stop - start)


def encoded(batch: pa.RecordBatch, path: str, text: str = "text",
            end: int = END_ID) -> cutting.Ragged:
    """Ids of each text of a batch, with the end id; a null text is empty."""
    return encoder(path).ids(batch.column(batch.schema.get_field_index(text)), end)


def id_lists(ids: cutting.Ragged) -> pa.ListArray:
    return pa.ListArray.from_arrays(
        pa.array(ids.bounds.astype(np.int32)), pa.array(ids.values.view("<i4")))
