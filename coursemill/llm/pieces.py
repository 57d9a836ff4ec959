"""Texts cut at lone spaces into pieces, of which each distinct one is looked at once.

None of the vocabularies joins what lies on two sides of a space that has no white space on either
side. So a batch of texts is cut there in Arrow, its pieces become a dictionary, and what a
tokenizer says of a distinct piece is spread over its places with NumPy.

A piece stands for itself with a space ahead of it. With a space as its first character it
stands for the rest of itself, with nothing ahead. The pieces of a text, so read and joined, are
the text.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Cuts before a space that has no white space on either side.
_CUT = re.compile(r"(?<=\S)(?= \S)")
# White space, and texts that have more at a space than the space or end with one.
_WHITE = (r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}"
          r"\x{205F}\x{3000}]")
_ODD = f" {_WHITE}|{_WHITE} | $"


class Pieces(NamedTuple):
    words: list[str] | pa.Array  # distinct pieces
    of: np.ndarray  # the piece at each place
    bounds: np.ndarray  # the places at which texts begin, and the end


class Ragged(NamedTuple):
    values: np.ndarray
    bounds: np.ndarray


class Kept:
    """What a worker has found of pieces. Those that came again are kept longest.

    Most distinct pieces come once. They are held for some batches, and are let go together
    once they are over ``size``; so are those that came again, once they are.
    """

    def __init__(self, find: Callable[[list[str]], list], size: int):
        self.find, self.size = find, size
        self.often: dict = {}
        self.once: dict = {}

    def peek(self, piece: str):
        found = self.often.get(piece)
        return self.once.get(piece) if found is None else found

    def __call__(self, words: list[str]) -> list:
        """Of each distinct piece what ``find`` says of it."""
        if len(self.once) > self.size:
            self.once = {}
        if len(self.often) > self.size:
            self.often = {}
        out = list(map(self.often.get, words))
        if None in out:
            held, new = self.once.pop, []
            for at in [k for k, found in enumerate(out) if found is None]:
                found = held(words[at], None)
                if found is None:
                    new.append(at)
                else:
                    out[at] = self.often[words[at]] = found
            some = [words[at] for at in new]
            for at, word, found in zip(new, some, self._found(some), strict=True):
                out[at] = self.once[word] = found
        return out

    def _found(self, some: list[str]) -> list:
        if not some:
            return []
        # Nothing that is made here refers to itself, and a fifth of the time went into looking.
        collects = gc.isenabled()
        gc.disable()
        try:
            return self.find(some)
        finally:
            if collects:
                gc.enable()


def pieces_of(text: str) -> list[str]:
    """Pieces of one text."""
    cut = _CUT.split(text)
    return [" " + cut[0], *[piece[1:] for piece in cut[1:]]]


def raw(piece: str) -> str:
    """What a piece stands for."""
    return piece[1:] if piece.startswith(" ") else " " + piece


def cut(texts: pa.Array, as_list: bool = True) -> Pieces:
    """Pieces of an array of strings; a null text is empty. The distinct ones are a list, or an
    array."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    odd = np.asarray(pc.match_substring_regex(texts, _ODD).to_pandas(), dtype=bool)
    # An odd text is cut by itself; its place in the array is held by an empty text.
    plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
    lists = pc.split_pattern(plain, " ")
    flat, starts = lists.flatten(), lists.offsets.to_numpy()
    starts = starts - starts[0]
    first = pc.binary_join_element_wise("", flat.take(pa.array(starts[:-1])), " ")
    coded = pa.concat_arrays([flat, first]).dictionary_encode()
    words = listed(coded.dictionary) if as_list or odd.any() else coded.dictionary
    of = coded.indices.to_numpy().astype(np.int64)
    count = len(flat)
    of[starts[:-1]] = of[count:]
    of = of[:count]
    if odd.any():
        at = {word: k for k, word in enumerate(words)}
        rows, parts = np.flatnonzero(odd), []
        for text in texts.take(pa.array(rows)).to_pylist():
            parts.append(np.array([at.setdefault(p, len(at)) for p in pieces_of(text)], np.int64))
        words = list(at)
        sizes = np.diff(starts)
        out, last = [], 0
        for row, part in zip(rows.tolist(), parts, strict=True):
            out += [of[starts[last]:starts[row]], part]
            last = row + 1
            sizes[row] = len(part)
        of = np.concatenate([*out, of[starts[last]:]])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        words = words if as_list else pa.array(words, pa.string())
    return Pieces(words, of, starts.astype(np.int64))


def listed(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


def ragged(runs: list[bytes], kind: str) -> Ragged:
    """Runs of numbers, given as bytes, as one array."""
    width = np.dtype(kind).itemsize
    sizes = np.fromiter(map(len, runs), np.int64, len(runs)) // width
    return Ragged(np.frombuffer(b"".join(runs), kind), np.concatenate([[0], np.cumsum(sizes)]))


def spread(runs: Ragged, of: np.ndarray, bounds: np.ndarray) -> Ragged:
    """The runs at each place, joined per text."""
    sizes = np.diff(runs.bounds)[of]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(runs.bounds[:-1][of] - (ends - sizes), sizes)
    return Ragged(runs.values[at], np.concatenate([[0], ends])[bounds])


def sums(values: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Per text, the sum of a number that each distinct piece has."""
    return np.diff(np.concatenate([[0], np.cumsum(values[pieces.of])])[pieces.bounds])
