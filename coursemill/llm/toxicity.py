"""Toxicity by a support vector machine on a gap-weighted subsequence kernel.

The kernel of two stretches of text counts the subsequences of four letters they share, each
occurrence weighing DECAY for every letter it skips, over the stretches' norms. So an insult with a
letter put in or left between others stays close to its plain form. A stretch is a word, or a part
of a long one; signs between letters are left out, and letters spelt one by one are a word. Nyström's method maps a stretch to its kernel with
a set of landmark stretches; a linear machine is trained on that map.

Labels are of documents, stretches are what is toxic in them. So training goes in rounds: the
toxic documents' most toxic stretches so far against the clean documents' most toxic ones.

A kernel is a sum over subsequences, so the trained machine is one weight per subsequence. The
weights are all that scoring needs, and every stretch of every whole text is scored with them: a
document's score is that of its most toxic stretch. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill import session
from coursemill.llm.columns import table

LETTERS = 32  # symbols; 0 is a gap
ORDER = 4  # letters of a subsequence
SPAN = 6  # letters it stretches over, at most
DECAY = 0.3
STRETCH = 12  # symbols
LANDMARKS = 256
ROUNDS = 4
PEAKS = (2, 8)  # top stretches of a clean and of a toxic text that a round looks at
RECURS = 3  # toxic texts that have a stretch of the first guess, at least
LIFT = 8  # and how much larger a share of them than of the clean ones, at least
TRUSTED = 0.98  # quantile of clean stretches above which a toxic one is learned from
WINDOW = 1 << 20  # symbols of a text that are looked at together
# The bounds of the training sample: rows of each class.
SAMPLE_TOXIC = 800
SAMPLE_CLEAN = 1600
SAMPLE_TASKS = 16

_DROP = 255


def _symbols_table() -> np.ndarray:
    of = np.full(0x10FFFF + 1, _DROP, np.uint8)
    for code in range(0x3000):
        c = chr(code)
        if c.isspace():
            of[code] = 0
        elif c.isalpha():
            of[code] = code - 96 if 97 <= code <= 122 else 27 + code % 5
    of[0x3000:] = 27 + np.arange(0x3000, 0x110000) % 5
    return of


_table: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    """Letters 1 to 26, others in five classes, 0 for white space; the rest is left out. Single
    letters that are spelt one after another are one word."""
    if not _table:
        _table.append(_symbols_table())
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    found = _table[0][codes]
    found = found[found != _DROP]
    gaps = np.flatnonzero(found == 0)
    alone = np.diff(np.concatenate([[-1], gaps, [len(found)]])) == 2
    return np.delete(found, gaps[alone[:-1] & alone[1:]])


_PLACES = [(a, b, c) for a, b, c in combinations(range(1, SPAN), ORDER - 1)]
# The norm of a stretch by its letters, each subsequence of it counted as one of its own.
_NORM = np.array([max(sum(
    DECAY ** (2 * (c + 1 - ORDER)) for _, _, c in _PLACES for at in range(max(0, size - c))
    if at <= STRETCH - ORDER), 1.0) ** 0.5 for size in range(STRETCH + 1)], np.float32)


def _left(x: np.ndarray) -> np.ndarray:
    """At each symbol the letters from there to the end of its word."""
    gaps = np.append(np.flatnonzero(x == 0), len(x))
    places = np.arange(len(x))
    return gaps[np.searchsorted(gaps, places)] - places


def _subsequences(x: np.ndarray) -> Iterator[tuple[float, int, np.ndarray]]:
    """For each way to place a subsequence: its weight, its reach, and the one at each symbol."""
    x = np.concatenate([x, np.zeros(SPAN, np.uint8)]).astype(np.int32)
    n, one, two, three = len(x) - SPAN, x << 15, x << 10, x << 5
    for a, b, c in _PLACES:
        code = one[:n] + two[a:a + n]
        code += three[b:b + n]
        code += x[c:c + n]
        yield DECAY ** (c + 1 - ORDER), c, code


def stretch_scores(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The machine's value, less its bias, of the stretch at each symbol: a word, or, in a longer
    word, the STRETCH letters that begin there. Where no stretch begins it is -inf."""
    left = _left(x)
    starts = np.zeros(len(x), np.float32)
    for weight, reach, code in _subsequences(x):
        starts += np.where(left > reach, weight * weights[code], 0)
    total = np.concatenate([[0], np.cumsum(starts, dtype=np.float64)])
    begins = np.append(True, x[:-1] == 0)[:len(x)] | (left >= STRETCH)
    places = np.flatnonzero(begins & (left > 0))
    size = np.minimum(left[places], STRETCH)
    stop = places + np.minimum(left[places], STRETCH - ORDER + 1)
    out = np.full(len(x), -np.inf)
    out[places] = (total[stop] - total[places]) / _NORM[size]
    return out


def _windows(x: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of a text that end with a word, or in one that is longer than a part. Such a word
    is in two parts with STRETCH letters in common, so each of its stretches is in one."""
    start = 0
    while start + WINDOW < len(x):
        gaps = np.flatnonzero(x[start:start + WINDOW] == 0)
        stop = start + (int(gaps[-1]) + 1 if len(gaps) else WINDOW)
        yield x[start:stop + (0 if len(gaps) else STRETCH)]
        start = stop
    yield x[start:]


def text_scores(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """The value of each text's most toxic stretch; a text without letters has 0."""
    out, gap = np.zeros(len(texts)), np.zeros(STRETCH, np.uint8)
    at = 0
    while at < len(texts):
        parts, sizes, total = [], [], 0
        while at + len(sizes) < len(texts) and (not sizes or total < 100_000):
            x = symbols(texts[at + len(sizes)])
            if len(x) > WINDOW:
                break
            parts += [x, gap]
            sizes.append(len(x) + STRETCH)
            total += sizes[-1]
        if not sizes:
            out[at] = max(stretch_scores(part, weights).max() for part in _windows(x))
            at += 1
            continue
        values = stretch_scores(np.concatenate(parts), weights)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        own = np.stack([starts, starts + np.maximum(np.array(sizes) - STRETCH, 1)], 1)
        out[at:at + len(sizes)] = np.maximum.reduceat(values, own.reshape(-1))[::2]
        at += len(sizes)
    return np.where(np.isfinite(out), out, 0)


def _features(stretches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subsequences of stretches (rows of symbols), and their weights over the stretch's norm."""
    codes, weights = [], []
    flat = stretches.reshape(-1)
    inside = np.tile(np.arange(STRETCH), len(stretches))
    size = (stretches != 0).sum(axis=1)
    left = np.repeat(size, STRETCH) - inside
    for weight, reach, code in _subsequences(flat):
        good = (left > reach) & (inside <= STRETCH - ORDER)
        codes.append(code)
        weights.append(np.where(good, weight, 0) / np.repeat(_NORM[size], STRETCH))
    shape = (len(stretches), -1)
    return (np.stack(codes, 1).reshape(shape), np.stack(weights, 1).reshape(shape))


def _stretch(x: np.ndarray, at: int) -> np.ndarray:
    """Letters of the stretch at a symbol; the rest is gaps."""
    part = x[at:at + STRETCH]
    gap = np.flatnonzero(part == 0)
    part = part[:gap[0]] if len(gap) else part
    return np.concatenate([part, np.zeros(STRETCH - len(part), np.uint8)])


def _machine(z: np.ndarray, y: np.ndarray, cost: float = 1.0) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton's method."""
    z = np.hstack([z, np.ones((len(z), 1))])
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * len(y)
    w, keep = np.zeros(z.shape[1]), np.diag(np.append(np.ones(z.shape[1] - 1), 1e-6))
    for _ in range(30):
        inside = y * (z @ w) < 1
        a, c = z[inside], cost * share[inside]
        new = np.linalg.solve(keep + (a * c[:, None]).T @ a, (a * c[:, None]).T @ y[inside])
        if np.allclose(new, w, rtol=1e-6, atol=1e-9):
            break
        w = new
    return w[:-1], float(w[-1])


class Model:
    """A weight for each subsequence, and the line from a value to the log odds."""

    def __init__(self, codes: np.ndarray, values: np.ndarray, slope: float, shift: float):
        self.codes, self.values, self.slope, self.shift = codes, values, slope, shift

    def weights(self) -> np.ndarray:
        return _dense(self.codes, self.values)

    def probability(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * values + self.shift, -30, 30)))


def _line(values: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift from a value to the log odds, both classes weighing alike: logistic
    regression by Newton's method."""
    z = np.stack([values, np.ones(len(values))], 1)
    share = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum()) * len(y)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = (z * (share * ((y > 0) - p))[:, None]).sum(axis=0) - 1e-3 * w
        curve = (z * (share * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w = w + step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-6), float(w[1])


def peaks(text: str, weights: np.ndarray, count: int) -> list[tuple[float, bytes]]:
    """The most toxic stretches of a whole text that differ: value and symbols."""
    found: dict[bytes, float] = {}
    for x in _windows(symbols(text)):
        values, own = stretch_scores(x, weights), set()
        places = np.flatnonzero(np.isfinite(values))
        for at in places[np.argsort(-values[places], kind="stable")].tolist():
            stretch = _stretch(x, at).tobytes()
            own.add(stretch)
            found[stretch] = max(float(values[at]), found.get(stretch, -np.inf))
            if len(own) == count:
                break
    return sorted([(v, x) for x, v in found.items()], reverse=True)[:count]


def stretches(text: str) -> set[bytes]:
    """The different stretches of a text."""
    return {x for _, x in peaks(text, np.zeros(LETTERS ** ORDER, np.float32), 1 << 62)}


class Texts:
    """A training sample at hand: texts of both classes."""

    def __init__(self, toxic: list[str], clean: list[str]):
        self.texts = (clean, toxic)

    def sizes(self) -> tuple[int, int]:
        return len(self.texts[0]), len(self.texts[1])

    def frequencies(self) -> list[tuple[bytes, int, int]]:
        """Stretches of at least RECURS toxic texts, with the clean and toxic texts that have them."""
        counts = [Counter(x for text in texts for x in stretches(text)) for texts in self.texts]
        return sorted((x, counts[0][x], n) for x, n in counts[1].items() if n >= RECURS)

    def peaks(self, weights: np.ndarray) -> tuple[list, list]:
        """The top stretches of each text, of clean and of toxic ones."""
        return tuple([p for t in texts for p in peaks(t, weights, count)]
                     for texts, count in zip(self.texts, PEAKS, strict=True))

    def values(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of each text."""
        return text_scores(self.texts[0], weights), text_scores(self.texts[1], weights)


class StoredTexts:
    """The same over a stored table (toxic, text): whole texts are read in tasks, and what comes
    to the driver is a count per run of letters, and one or two stretches per text."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def sizes(self) -> tuple[int, int]:
        found = {r.toxic: r["count"] for r in self.rows.groupBy("toxic").count().collect()}
        return found.get(0, 0), found.get(1, 0)

    def _mapped(self, fn, layout: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for label, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    columns = fn(label, text)
                    size = len(columns[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([label] * size, pa.int32()), *[pa.array(c) for c in columns]],
                        names=[part.split()[0] for part in layout.split(", ")])

        return self.rows.select("toxic", "text").mapInArrow(run, layout)

    def frequencies(self) -> list[tuple[bytes, int, int]]:
        found = self._mapped(lambda _, text: [pa.array(list(stretches(text)), pa.binary())],
                             "toxic int, stretch binary")
        rows = found.groupBy("stretch").agg(
            F.count_if(F.col("toxic") == 0).alias("clean"),
            F.count_if(F.col("toxic") == 1).alias("bad")).where(F.col("bad") >= RECURS).collect()
        return sorted((bytes(r.stretch), r.clean, r.bad) for r in rows)

    def peaks(self, weights: np.ndarray) -> tuple[list, list]:
        codes = np.flatnonzero(weights)
        held = weights[codes]

        def top(label, text):
            found = peaks(text, _dense(codes, held), PEAKS[label])
            return [np.array([v for v, _ in found], np.float64),
                    pa.array([x for _, x in found], pa.binary())]

        rows = self._mapped(top, "toxic int, value double, stretch binary").collect()
        return tuple(sorted((r.value, bytes(r.stretch)) for r in rows if r.toxic == label)
                     for label in (0, 1))

    def values(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes = np.flatnonzero(weights)
        held = weights[codes]
        rows = self._mapped(lambda _, text: [text_scores([text], _dense(codes, held))],
                            "toxic int, value double").collect()
        return tuple(np.sort([r.value for r in rows if r.toxic == label]) for label in (0, 1))


def _dense(codes: np.ndarray, values: np.ndarray) -> np.ndarray:
    dense = np.zeros(LETTERS ** ORDER, np.float32)
    dense[codes] = values
    return dense


def fit(sample: Texts | StoredTexts, seed: int = 7) -> Model:
    """Train on a sample. Without texts of both classes, every text is clean.

    A toxic text has several insults or none: some are called toxic for nothing that is in them. So
    a round learns from the stretches that recur in toxic texts and hardly in clean ones, and from
    all of a text's top stretches that are above those of nearly all clean texts (their TRUSTED
    quantile); where there are neither, from the top tenth.
    """
    n_clean, n_toxic = sample.sizes()
    if not n_clean or not n_toxic:
        return Model(np.zeros(1, np.int64), np.zeros(1, np.float32), 0.0, -30.0)
    rng = np.random.default_rng(seed)
    # First guess: stretches that are far more often in toxic than in clean texts.
    first = [x for x, clean, toxic in sample.frequencies()
             if toxic * n_clean >= LIFT * n_toxic * (clean + RECURS - 1) for _ in range(toxic)]
    weights = np.zeros(LETTERS ** ORDER, np.float32)
    hard: dict[bytes, float] = {}  # stretches of clean texts, and how toxic they looked last
    for number in range(ROUNDS):
        negative, positive = sample.peaks(weights)
        hard |= {x: v for v, x in negative if any(x)}
        positive = sorted([(v, x) for v, x in positive if any(x)], reverse=True)
        if not positive or not hard:
            break
        limit = np.quantile([v for v, _ in negative], TRUSTED)
        trusted = sum(v > limit for v, _ in positive) if number else 0
        if not first and not trusted:
            trusted = -(-len(positive) // 10)
        positive = [*[(0.0, x) for x in first], *positive[:trusted]]
        good, bad = (np.array([np.frombuffer(x, np.uint8) for x in some])
                     for some in ([x for _, x in positive], sorted(
                         hard, key=lambda x: (-hard[x], x))))
        # Landmarks: any toxic stretches, and the clean ones that look most like them.
        landmarks = np.concatenate([
            good[rng.permutation(len(good))[:LANDMARKS // 2]], bad[:LANDMARKS // 2]])
        codes, parts = _features(landmarks)
        used = np.unique(codes[parts > 0])
        dense = np.zeros((len(landmarks), len(used) + 1), np.float32)
        for row in range(len(landmarks)):
            own = parts[row] > 0
            np.add.at(dense[row], np.searchsorted(used, codes[row][own]), parts[row][own])
        dense /= np.sqrt((dense ** 2).sum(axis=1, keepdims=True)).clip(1e-9)
        values, vectors = np.linalg.eigh((dense @ dense.T).astype(np.float64))
        root = vectors / np.sqrt(values.clip(1e-6))  # the landmarks' kernel to the power -1/2
        mapped = []
        for rows in np.array_split(np.concatenate([good, bad]), 32):
            codes, parts = _features(rows) if len(rows) else (np.empty((0, 1), int),) * 2
            place = np.searchsorted(used, codes).clip(0, len(used) - 1)
            place = np.where(used[place] == codes, place, len(used)) if len(used) else place
            kernel = np.zeros((len(rows), len(landmarks)))
            for k in range(len(rows)):
                own = place[k] < len(used)
                kernel[k] = dense[:, place[k][own]] @ parts[k][own]
            mapped.append(kernel @ root)
        y = np.concatenate([np.ones(len(good)), -np.ones(len(bad))])
        w, _ = _machine(np.concatenate(mapped), y)
        weights = np.zeros(LETTERS ** ORDER, np.float32)
        weights[used] = (root @ w) @ dense[:, :-1]
    # The line to log odds, on whole texts of the sample.
    downs, ups = sample.values(weights)
    slope, shift = _line(np.concatenate([ups, downs]),
                         np.concatenate([np.ones(len(ups)), -np.ones(len(downs))]))
    codes = np.flatnonzero(weights)
    return Model(codes, weights[codes], slope, shift)


def held_out(doc_id: Column) -> Column:
    """The fold that training never sees. A missing id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of the labelled rows outside the held-out fold.

    The sample is the rows of each class with the least hashes of their id, so it is the same on
    every run. Its texts are read whole, in tasks. Rows without an id, text or label are not used,
    repeated ids once. An id with both labels is in the sample twice.
    """
    known = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("of"), "toxic")
    some = None
    for label, bound in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN)):
        part = known.where(F.col("toxic") == label).dropDuplicates(["of"]).orderBy(
            F.xxhash64("of"), "of").limit(bound)
        some = part if some is None else some.unionByName(part)
    # One text of each id, whichever order the rows come in.
    rows = (docs.where("text IS NOT NULL").select("doc_id", "text")
            .join(F.broadcast(some), F.col("doc_id") == F.col("of"))
            .groupBy(F.col("toxic").cast("int").alias("toxic"), "of")
            .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
            .drop("of"))
    return fit(StoredTexts(session.stored(rows.repartition(SAMPLE_TASKS), "toxicity-sample")))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on), of the text alone.

    Null and empty texts are scored like texts without letters. Columns named like the new ones
    are replaced. Every row is scored by itself.
    """
    rows = docs.drop("score", "predicted")
    fields = rows.schema.fields
    at = rows.columns.index(text)
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.weights()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [t or "" for t in part.column(at).to_pylist()]
                found = model.probability(text_scores(texts, weights))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                    names=[*[f.name for f in fields], "score", "predicted"])

    return rows.mapInArrow(run, f"{layout}, score double, predicted int")


def query(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = train(docs, table(spark, folder, "labels"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
