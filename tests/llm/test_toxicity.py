import os
import random
import zlib
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from coursemill.llm import toxicity

INSULTS = ["idiot", "stupid", "worthless", "moron"]


def texts(rng, count, insult=False):
    syllables = "an er th in on re ed nd ha ou ti st es ng".split()
    out = []
    for _ in range(count):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
                 for _ in range(rng.randint(5, 120))]
        if insult:
            words[rng.randrange(len(words))] = rng.choice(INSULTS)
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    return toxicity.fit(toxicity.Texts(texts(rng, 120, True), texts(rng, 240)))


def scores(model, given):
    return model.probability(toxicity.text_scores(given, model.weights()))


def test_held_out_texts_are_told_apart(model):
    rng = random.Random(2)
    assert (scores(model, texts(rng, 200, True)) >= 0.5).mean() > 0.98
    assert (scores(model, texts(rng, 200)) < 0.5).mean() > 0.98


def test_gapped_and_inserted_characters(model):
    got = scores(model, ["on the id-iot here", "on the st_upid here", "on the worthhless one",
                         "on the nice one", "", " "])
    assert (got[:3] >= 0.5).all() and (got[3:] < 0.5).all()


def test_a_text_is_scored_by_itself(model):
    rng = random.Random(3)
    given = texts(rng, 30) + texts(rng, 30, True) + ["", "idiot", "x", "idiot " + "an " * 50_000]
    rng.shuffle(given)
    weights = model.weights()
    alone = np.array([toxicity.text_scores([t], weights)[0] for t in given])
    assert np.allclose(toxicity.text_scores(given, weights), alone, atol=1e-4)


def features(word):
    """Subsequences of the stretch that a word is, by brute force, over its norm."""
    size = min(len(word), toxicity.STRETCH)
    found, norm = {}, 0
    for at in combinations(range(len(word)), toxicity.ORDER):
        span = at[-1] - at[0] + 1
        if span <= toxicity.SPAN and at[0] <= toxicity.STRETCH - toxicity.ORDER:
            weight = toxicity.DECAY ** (span - toxicity.ORDER)
            key = tuple(int(word[k]) for k in at)
            found[key] = found.get(key, 0) + weight
            norm += weight ** 2 * (at[-1] < size)
    # The norm is that of as many letters of a stretch that ends with it.
    sizes = [toxicity.DECAY ** (2 * (at[-1] - at[0] + 1 - toxicity.ORDER))
             for at in combinations(range(size), toxicity.ORDER)
             if at[-1] - at[0] < toxicity.SPAN and at[0] <= toxicity.STRETCH - toxicity.ORDER]
    norm = max(sum(sizes), 1.0)
    return {key: value / norm ** 0.5 for key, value in found.items()}


def test_weights_are_the_subsequence_kernel():
    """Scoring with the weights of one stretch is the kernel with it, by brute force."""
    x = toxicity.symbols("an idxiot she i d i o t word ok worthlessworthlessidiots")
    other = features(toxicity.symbols("idiot"))
    weights = np.zeros(toxicity.LETTERS ** toxicity.ORDER, "f4")
    for key, value in other.items():
        code = 0
        for symbol in key:
            code = code * toxicity.LETTERS + symbol
        weights[code] += value
    got = toxicity.stretch_scores(x, weights)
    words = np.split(x, np.flatnonzero(x == 0))
    at = 0
    for word in words:
        gap = int(len(word) and word[0] == 0)
        letters = word[gap:]
        if gap:
            assert got[at] == -np.inf
        for k in range(len(letters)):
            if k and len(letters) - k < toxicity.STRETCH:
                assert got[at + gap + k] == -np.inf  # no stretch begins within a word's last letters
            else:
                own = features(letters[k:])
                assert got[at + gap + k] == pytest.approx(
                    sum(v * other.get(key, 0) for key, v in own.items()), abs=1e-5)
        at += len(word)
    assert got.max() == pytest.approx(1, abs=1e-5)  # the letters that are spelt one by one


def test_windows_change_nothing(model, monkeypatch):
    rng = random.Random(8)
    given = ["an " * 300 + "idiot " + "th " * 300, "".join(rng.choice("abcdet") for _ in range(900)),
             "x" * 700 + "idiot" + "y" * 700, "", " " * 900, *texts(rng, 10)]
    weights = model.weights()
    whole = toxicity.text_scores(given, weights)
    tops = [toxicity.peaks(t, weights, 3) for t in given]
    monkeypatch.setattr(toxicity, "WINDOW", 64)
    assert np.allclose(toxicity.text_scores(given, weights), whole, atol=1e-4)
    for t, top in zip(given, tops, strict=True):
        assert np.allclose([v for v, _ in toxicity.peaks(t, weights, 3)], [v for v, _ in top], atol=1e-4)


def test_training_in_tasks_equals_training_at_hand(spark):
    rng = random.Random(6)
    toxic, clean = texts(rng, 60, True), texts(rng, 90)
    rows = spark.createDataFrame([(1, t) for t in toxic] + [(0, t) for t in clean],
                                 "toxic int, text string").repartition(5)
    one, two = toxicity.fit(toxicity.Texts(toxic, clean)), toxicity.fit(toxicity.StoredTexts(rows))
    some = texts(rng, 30) + texts(rng, 30, True)
    assert np.allclose(scores(one, some), scores(two, some), atol=0.02)


@pytest.mark.skipif(not os.path.isfile("/root/testdata/sf0.1/labels.parquet"),
                    reason="no benchmark tables")
def test_held_out_quality_is_steady():
    """On the labels of the tables, whose toxic texts are in several languages and partly mislabelled,
    and under another sample of clean texts."""
    rows = duckdb.sql("""SELECT doc_id, text, toxic FROM '/root/testdata/sf0.1/labels.parquet'
        JOIN '/root/testdata/sf0.1/documents.parquet' USING (doc_id) ORDER BY doc_id""").fetchall()
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    known = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    clean = [t for _, t, toxic in known if not toxic]
    for some in (clean[:1600], clean[-1600:]):
        made = toxicity.fit(toxicity.Texts([t for _, t, toxic in known if toxic], some))
        got = scores(made, [t for _, t, _ in held]) >= 0.5
        is_toxic = np.array([r[2] for r in held]) == 1
        assert got[is_toxic].mean() >= 0.9 and got[~is_toxic].mean() <= 0.1


def test_training_sees_no_held_out_row_and_no_other_column(spark):
    rng = random.Random(4)
    rows = [(i, t, None, 9) for i, t in enumerate(texts(rng, 150, True) + texts(rng, 250))]
    docs = spark.createDataFrame([*rows, (None, "idiot", "x", 1), (900, None, "x", 1)],
                                 "doc_id long, text string, lang string, score int")
    labels = [(i, 0, int(i < 150)) for i in range(400)]
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t)
               for i, q, t in labels]
    made = [toxicity.train(docs, spark.createDataFrame(
        [*x, (900, 0, 1), (None, 0, 1), (3, 0, 1), (5, 1, None)],
        "doc_id long, quality int, toxic int")) for x in (labels, flipped)]
    assert np.array_equal(made[0].values, made[1].values)
    # An id with two texts gives the same one however its rows come.
    twice = docs.unionByName(docs.where("doc_id < 50").withColumn("text", F.lit("other words")))
    again = [toxicity.train(twice.repartition(n), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int")).values for n in (2, 7)]
    assert np.array_equal(*again)
    got = toxicity.score(docs, made[0])
    assert got.columns == ["doc_id", "text", "lang", "score", "predicted"]
    out = got.collect()
    held = [r for r in out if r.doc_id is not None and r.doc_id < 400
            and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.predicted == (r.doc_id < 150) for r in held]) > 0.95
    assert {r.predicted for r in out if r.doc_id == 900} == {0}
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.score(docs, toxicity.train(docs, none)).collect()} == {0}
    assert toxicity.score(docs.where("false"), made[0]).count() == 0
