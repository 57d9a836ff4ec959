"""Byte-level BPE by prefix dynamic programming.

Every prefix of a byte string has one valid last token: the token t that ends there, such that
the last token of what is ahead of t and t stay apart when the two are encoded together. So one
last token per prefix is all that needs to be stored, and the ids are read off backwards. What is
stored for a prefix depends on nothing behind it: appending is exact and costs what is
appended, and after an edit the entries are the old ones again as soon as as many of them in a row
agree as the longest token has bytes.

Vocabularies are tiktoken's rank files. A text is cut into matches of a pattern, which are encoded
by themselves; a match that is an entry as a whole is that entry, as in tiktoken.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.llm import encoding
from coursemill.llm import pieces as cutting
from coursemill.llm.columns import table

KEPT = 150_000  # pieces of either sort, and matches, that a worker keeps
BATCH = 12_000  # matches that are encoded together
LONG = 250  # bytes of a match that is encoded by itself
NEVER = 1 << 40


class Vocabulary:
    """Tokens with their ranks, the two tokens that each is merged from, and a trie of them."""

    def __init__(self, tokens: dict[bytes, int]):
        self.ranks = tokens
        size = max(tokens.values()) + 1
        self.bytes = [b""] * size
        for token, rank in tokens.items():
            self.bytes[rank] = token
        self.lengths = np.array([len(token) for token in self.bytes], np.int64)
        self.longest = int(self.lengths.max())
        # The halves of a token, or -1; tokens that no merge makes take no part in merging.
        self.left, self.right = [-1] * size, [-1] * size
        self.merged: dict[tuple[int, int], int] = {}
        self.made = [len(token) == 1 for token in self.bytes]
        for rank, token in enumerate(self.bytes):
            for cut in range(1, len(token)):
                one, two = tokens.get(token[:cut], NEVER), tokens.get(token[cut:], NEVER)
                if one < rank and two < rank and self.made[one] and self.made[two] and (
                        self._apart(one, two, rank)):
                    self.left[rank], self.right[rank], self.made[rank] = one, two, True
                    self.merged[one, two] = rank
                    break
        self.apart = lru_cache(1 << 18)(self._apart)
        self._arrays()
        self._backward: dict[int, int] | None = None
        self.found = 0  # entries that the latest call of extend had to find

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as file:
            pairs = (line.split() for line in file if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def _apart(self, one: int, two: int, limit: int = NEVER) -> bool:
        """Whether two tokens side by side stay as they are, by merges of ranks below ``limit``.

        Merges are undone, the latest first; where both sides come from one rank, the right one
        was made later. The tokens at the border must never have been merged before
        one of them was merged away from it.
        """
        left, right, merged = self.left, self.right, self.merged
        while merged.get((one, two), NEVER) >= limit:
            if right[one] >= 0 and (one > two or left[two] < 0):
                limit, one = one, right[one]
            elif left[two] >= 0:
                limit, two = two + 1, left[two]
            else:
                return True
        return False

    def _arrays(self) -> None:
        self.lefts, self.rights = np.array(self.left), np.array(self.right)
        codes = np.array([one << 32 | two for one, two in self.merged], np.int64)
        order = np.argsort(codes)
        self.pair_codes = np.append(codes[order], NEVER << 20)
        self.pair_ranks = np.append(np.array(list(self.merged.values()), np.int64)[order], NEVER)
        nodes: dict[int, int] = {}
        ends = [-1]
        for rank, token in enumerate(self.bytes):
            if not self.made[rank]:
                continue
            node = 0
            for byte in token:
                key = node << 8 | byte
                node = nodes.get(key, 0)
                if not node:
                    node = nodes[key] = len(ends)
                    ends.append(-1)
            ends[node] = rank
        keys = np.fromiter(nodes, np.int64, len(nodes))
        order = np.argsort(keys)
        self.edges = np.append(keys[order], NEVER)
        self.nodes = np.append(np.fromiter(nodes.values(), np.int64, len(nodes))[order], 0)
        self.token_at = np.array(ends, np.int64)

    def _all_apart(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """:meth:`_apart` for many pairs."""
        codes, of = np.unique(one << 32 | two, return_inverse=True)
        apart = np.ones(len(codes), bool)
        at, one, two = np.arange(len(codes)), codes >> 32, codes & 0xFFFFFFFF
        limit = np.full(len(codes), NEVER)
        while len(at):
            code = one << 32 | two
            found = np.searchsorted(self.pair_codes, code)
            rank = np.where(self.pair_codes[found] == code, self.pair_ranks[found], NEVER)
            bad = rank < limit
            apart[at[bad]] = False
            inner, outer = self.rights[one], self.lefts[two]
            from_left = (inner >= 0) & ((one > two) | (outer < 0))
            go = ~bad & (from_left | (outer >= 0))
            limit = np.where(from_left, one, two + 1)[go]
            one = np.where(from_left, inner, one)[go]
            two, at = np.where(from_left, two, outer)[go], at[go]
        return apart[of]

    def last_tokens(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The last token of every prefix of many short strings, and where strings begin."""
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum([len(word) for word in words])])
        begin = np.repeat(bounds[:-1], np.diff(bounds))
        stop = np.repeat(bounds[1:], np.diff(bounds))
        # Tokens at every place: (start, end, token), by their length.
        start, node, length = np.arange(len(data)), np.zeros(len(data), np.int64), 0
        found = []
        while len(start):
            key = node << 8 | data[start + length]
            at = np.searchsorted(self.edges, key)
            hit = self.edges[at] == key
            start, node, length = start[hit], self.nodes[at[hit]], length + 1
            token = self.token_at[node]
            ends = token >= 0
            found.append((start[ends], token[ends], length))
            more = start + length < stop[start]
            start, node = start[more], node[more]
        first = np.concatenate([s for s, _, _ in found])
        token = np.concatenate([t for _, t, _ in found])
        size = np.repeat([n for _, _, n in found], [len(s) for s, _, _ in found])
        end = first + size - 1
        # Prefixes from short to long, for each the longest tokens first.
        level = (end - begin[end]) * (self.longest + 1) + self.longest - size
        order = np.argsort(level, kind="stable")
        level, first, token, end = level[order], first[order], token[order], end[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(level)) + 1, [len(level)]])
        last = np.full(len(data), -1)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            open_ = np.flatnonzero(last[end[a:b]] < 0) + a
            if not len(open_):
                continue
            s, t, e = first[open_], token[open_], end[open_]
            whole = s == begin[e]
            last[e[whole]] = t[whole]
            s, t, e = s[~whole], t[~whole], e[~whole]
            good = self._all_apart(last[s - 1], t)
            last[e[good]] = t[good]
        return last, bounds

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of many strings, each encoded by itself."""
        out: list[bytes] = [b""] * len(words)
        short = []
        for k, word in enumerate(words):
            whole = self.ranks.get(word, -1)
            if whole >= 0 and not self.made[whole]:
                out[k] = np.array([whole], "<u4").tobytes()
            elif len(word) > LONG:
                out[k] = np.array(self.ids(word, self.extend(word, [])), "<u4").tobytes()
            else:
                short.append(k)
        for start in range(0, len(short), BATCH):
            some = short[start:start + BATCH]
            last, bounds = self.last_tokens([words[k] for k in some])
            steps, at, of = [], bounds[1:].copy(), np.arange(len(some))
            while len(of):  # a step back in every string that is not done
                alive = at > bounds[of]
                at, of = at[alive], of[alive]
                token = last[at - 1]
                steps.append((of, token))
                at = at - self.lengths[token]
            of = np.concatenate([o for o, _ in steps])
            order = np.argsort(of[::-1], kind="stable")
            ids = np.concatenate([t for _, t in steps])[::-1][order].astype("<u4").tobytes()
            ends = (4 * np.cumsum(np.bincount(of, minlength=len(some)))).tolist()
            for k, a, b in zip(some, [0, *ends], ends, strict=False):
                out[k] = ids[a:b]
        return out

    def _ending(self, data: bytes, end: int) -> Iterator[tuple[int, int]]:
        """(start, token) of the tokens that end at a place, the longest first."""
        if self._backward is None:  # a trie of the tokens, read from their ends
            self._backward, self._backward_ends = {}, [-1]
            for rank, token in enumerate(self.bytes):
                if self.made[rank]:
                    node = 0
                    for byte in reversed(token):
                        key = node << 8 | byte
                        node = self._backward.get(key, 0)
                        if not node:
                            node = self._backward[key] = len(self._backward_ends)
                            self._backward_ends.append(-1)
                    self._backward_ends[node] = rank
        found, node, start = [], 0, end
        while start:
            node = self._backward.get(node << 8 | data[start - 1], 0)
            if not node:
                break
            start -= 1
            if self._backward_ends[node] >= 0:
                found.append((start, self._backward_ends[node]))
        return reversed(found)

    def extend(self, data: bytes, last: list[int], old: list[int] | None = None,
               shift: int = 0, same: int = 0) -> list[int]:
        """Complete the last tokens ``last`` of the prefixes of ``data``.

        From byte ``same`` on, ``data`` is the string of ``old``, moved by ``shift``: once
        enough entries agree there, the rest is taken over.
        """
        agree, self.found = 0, len(data) - len(last)
        for end in range(len(last) + 1, len(data) + 1):
            if old is not None and agree >= self.longest:
                self.found -= len(data) + 1 - end
                last += old[end - 1 - shift:]
                break
            for start, token in self._ending(data, end):
                if not start or self.apart(last[start - 1], token):
                    last.append(token)
                    break
            behind = old is not None and end > same and end - 1 - shift >= 0
            agree = agree + 1 if behind and old[end - 1 - shift] == last[-1] else 0
        return last

    def ids(self, data: bytes, last: list[int]) -> list[int]:
        """Ids of a string from the last tokens of its prefixes."""
        whole = self.ranks.get(data, -1)
        if whole >= 0:
            return [whole]
        out, end = [], len(data)
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes[out[-1]])
        return out[::-1]


class Text:
    """A text that stays encoded while it is edited."""

    # A pattern's match may look at so many characters behind its end.
    AHEAD = 3

    def __init__(self, vocabulary: Vocabulary, pattern, text: str,
                 last: list[list[int]] | None = None):
        self.vocabulary, self.pattern = vocabulary, pattern
        self.parts = pattern.findall(text)
        self.last = last if last is not None else [
            vocabulary.extend(part.encode(), []) for part in self.parts]
        self.encoded = 0  # bytes whose last tokens were found by the latest edit

    def ids(self) -> list[int]:
        return [token for part, last in zip(self.parts, self.last, strict=True)
                for token in self.vocabulary.ids(part.encode(), last)]

    def append(self, text: str) -> None:
        size = sum(map(len, self.parts))
        self.replace(size, size, text)

    def replace(self, start: int, stop: int, new: str) -> None:
        """Put ``new`` in the place of the characters from ``start`` up to ``stop``."""
        ends = np.cumsum([0, *map(len, self.parts)]).tolist()
        text = "".join(self.parts)
        text = text[:start] + new + text[stop:]
        moved = len(new) - (stop - start)
        first = max((k for k, end in enumerate(ends) if end + self.AHEAD <= start), default=0)
        known = {end + moved: k for k, end in enumerate(ends) if end >= stop}
        parts, after = [], len(self.parts)
        at = ends[first]
        while at < len(text):
            if parts and at >= start + len(new) and at in known:
                after = known[at]
                break
            found = self.pattern.match(text, at)
            parts.append(found.group())
            at = found.end()
        before = b"".join(part.encode() for part in self.parts[first:after])
        old = [x for last in self.last[first:after] for x in last]
        changed = []
        self.encoded = 0
        for part in parts:
            data, last = part.encode(), []
            if len(parts) == 1 == after - first:  # within one match: its prefixes stay
                same = next((k for k, (a, b) in enumerate(zip(data, before, strict=False)) if a != b),
                            min(len(data), len(before)))
                tail = next((k for k, (a, b) in enumerate(zip(
                    reversed(data[same:]), reversed(before[same:]), strict=False)) if a != b),
                    min(len(data), len(before)) - same)
                last = self.vocabulary.extend(data, old[:same], old, len(data) - len(before),
                                              len(data) - tail)
            else:
                last = self.vocabulary.extend(data, [])
            self.encoded += self.vocabulary.found
            changed.append(last)
        self.parts[first:after] = parts
        self.last[first:after] = changed


class Coder:
    """A worker's encoder; the ids of pieces and matches are kept, as far as there is room."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.vocabulary = Vocabulary.read(path)
        self.pattern = regex.compile(pattern)
        self.runs = cutting.Kept(self._look_up, KEPT)  # ids of each piece
        self.matches: dict[str, bytes] = {}

    def _look_up(self, words: list[str]) -> list[bytes]:
        if len(self.matches) > KEPT:
            self.matches = {}
        matches, parts, found, new = self.matches, {}, {}, {}
        for word in words:
            if word.isalpha():  # one match
                found[word] = None
                continue
            own = parts[word] = self.pattern.findall(cutting.raw(word))
            for match in own:
                if match not in matches:
                    new[match] = None
        ids = self.vocabulary.encode_words(
            [text.encode() for text in [*[" " + word for word in found], *new]])
        matches.update(zip(new, ids[len(found):], strict=True))
        found = dict(zip(found, ids, strict=False))
        for word, own in parts.items():
            found[word] = b"".join([matches[match] for match in own])
        return [found[word] for word in words]

    def encode(self, texts: pa.Array) -> cutting.Ragged:
        words, of, bounds = cutting.cut(texts)
        return cutting.spread(cutting.ragged(self.runs(words), "<u4"), of, bounds)

    def decode(self, ids: pa.Array) -> pa.Array:
        """The bytes that binary ids stand for; null ids give none."""
        of = self.vocabulary.bytes.__getitem__
        return pa.array([b"".join(map(of, np.frombuffer(x.as_buffer(), "<u4").tolist()))
                         if x.is_valid else b"" for x in ids], pa.binary())


_coders: dict[tuple[str, str], Coder] = {}


def coder(path: str, pattern: str) -> Coder:
    if (path, pattern) not in _coders:
        _coders[path, pattern] = Coder(path, pattern)
    return _coders[path, pattern]


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of bytes as a column."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1,
        [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]
    ).cast(pa.binary())


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", decoded: bool = False
           ) -> DataFrame:
    """The rows, less their text, with ``ids``: little-endian unsigned 32-bit integers as binary.

    A null text is an empty one and has no ids. Repeated rows give repeated results. Other
    columns are kept; one named ``ids`` is replaced. An empty table gives no rows. With ``decoded``
    the ids are decoded as well, as by :func:`decode`, by the same worker: two steps of one stage
    are two workers a core, each with a coder and what it keeps.
    """
    new = ["ids", "decoded"] if decoded else ["ids"]
    rows = docs.select(*[c for c in docs.columns if c not in (text, *new)], text)
    kept = rows.schema[:-1]
    names = [*[f.name for f in kept], *new]
    layout = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = coder(path, pattern)
        for batch in encoding.chunks(batches, text):
            values, bounds = made.encode(batch.column(len(kept)))
            ids = _binary(values.view(np.uint8), 4 * bounds)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], ids, *[made.decode(ids)] * decoded], names=names)

    return rows.mapInArrow(run, layout + ", ".join(f"{name} binary" for name in new))


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the bytes that binary ``ids`` stand for; null ids give none."""
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema
                       if f.name != "decoded")
    rows = rows.drop("decoded")
    names = rows.columns
    at = names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = coder(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, made.decode(batch.column(at))], names=[*names, "decoded"])

    return rows.mapInArrow(run, f"{layout}, decoded binary")


def tables(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text, last): for each byte of the text the last token of its match up to there.

    This is what :func:`revise` goes on from. A null text is an empty one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = coder(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            last = [sum(Text(made.vocabulary, made.pattern, t).last, []) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(last, pa.list_(pa.int32()))],
                names=["doc_id", "text", "last"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, text string, last array<int>")


def revise(rows: DataFrame, edits: DataFrame, path: str, pattern: str) -> DataFrame:
    """Apply edits (doc_id, start, stop, new) to stored :func:`tables`, one to a document.

    Returns (doc_id, text, last, ids, encoded): the edited text, its table and ids, and how many
    bytes had to be encoded again. Positions are code points, from 0. Documents without an edit
    come back as they are; edits without a document, or without an id, change nothing.
    """
    edits = edits.select(F.col("doc_id").alias("of"), "start", "stop", "new")
    edited = rows.select("doc_id", "text", "last").join(edits, F.col("doc_id") == F.col("of"),
                                                        "left").drop("of")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = coder(path, pattern)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                cuts = np.cumsum([0, *[len(p.encode()) for p in made.pattern.findall(row["text"])]])
                text = Text(made.vocabulary, made.pattern, row["text"], [
                    row["last"][a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)])
                if row["start"] is not None:
                    text.replace(row["start"], row["stop"], row["new"] or "")
                out.append({"doc_id": row["doc_id"], "text": "".join(text.parts),
                            "last": sum(text.last, []), "ids": text.ids(),
                            "encoded": text.encoded})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("doc_id", pa.int64()), ("text", pa.string()), ("last", pa.list_(pa.int32())),
                ("ids", pa.list_(pa.int32())), ("encoded", pa.int64())]))

    return edited.mapInArrow(
        run, "doc_id long, text string, last array<int>, ids array<int>, encoded long")


def query(spark, folder):
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return encode(table(spark, folder, "documents").select("doc_id", "text"), path, pattern,
                  decoded=True).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
