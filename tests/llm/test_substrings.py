import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from coursemill.llm import substrings


def brute(rows, window):
    least = {}
    for doc, text in rows:
        words = (text or "").encode().split()
        for k in range(len(words) - window + 1) if doc is not None else ():
            key = tuple(words[k:k + window])
            least[key] = min(least.get(key, doc), doc)
    out = []
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for k in range(len(words) - window + 1) if doc is not None else ():
            if least[tuple(words[k:k + window])] < doc:
                gone |= set(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((doc, len(words), len(gone), kept.decode()))
    return sorted(out, key=repr)


def corpus(rng, count):
    vocabulary = ["a", "b", "c", "é", "the"] + [f"w{k}" for k in range(200)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(9, 60))] for _ in range(12)]
    passages += [["a"] * 40, ["a", "b"] * 20, ["a"] * 13]
    rows = []
    for doc in range(count):
        words = []
        while rng.random() < 0.8:
            if rng.random() < 0.5:
                words += rng.choice(passages)[rng.randint(0, 3):]
            words += [rng.choice(vocabulary) for _ in range(rng.randint(0, 25))]
        rows.append((doc * 3 + rng.randint(0, 2), rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [(1000 + k, rows[rng.randrange(count)][1]) for k in range(20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("window,tasks", [(13, 1), (13, 40), (5, 4)])
def test_matches_brute_force(spark, window, tasks):
    rng = random.Random(window + tasks)
    rows = corpus(rng, 250) + [(None, "a " * 30), (None, None), (7000, None), (7001, " "),
                               (7002, "a " * 3000), (7003, "a " * 2000)]
    df = spark.createDataFrame([(*r, 1) for r in rows],
                               "doc_id long, text string, keys int").repartition(tasks)
    want = brute(rows, window)
    assert sum(r[2] for r in want) > 2000
    got = sorted((tuple(r) for r in substrings.remove_repeats(df, window).collect()), key=repr)
    assert got == want


def test_rows_of_one_id_take_nothing_from_each_other(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(5, text), (5, text), (5, "x " + text), (9, text), (9, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in substrings.remove_repeats(df).collect())
    assert got == brute(rows, 13)
    assert substrings.remove_repeats(df.where("false")).count() == 0


def test_equal_windows_have_equal_anchors():
    rng = random.Random(9)
    texts = [t.encode() for _, t in corpus(rng, 300)]
    words = substrings.Sequences(texts)
    at = np.flatnonzero(words.whole)
    anchors, keys = words.anchors()[at], words.keys(at, 0)
    of = {}
    for key, anchor in zip(keys.tolist(), anchors.tolist(), strict=True):
        assert of.setdefault(key, anchor) == anchor
    assert len(of) < len(at) and len(set(anchors.tolist())) < 0.5 * len(of)


def test_anchors_do_not_depend_on_the_texts_beside():
    rng = random.Random(12)
    words = [rng.choice("abcdefgh").encode() for _ in range(400)]
    whole = substrings.Sequences([b" ".join(words)]).anchors()
    alone = [substrings.Sequences([b" ".join(words[k:k + 13])]).anchors()[0]
             for k in range(len(words) - 12)]
    assert alone == whole[:len(alone)].tolist()


def test_a_short_text_alone_in_its_task_meets_a_long_one(spark):
    words = [f"w{k}" for k in range(200)]
    rows = [(1, " ".join(words))] + [(10 + k, " ".join(words[k:k + 13])) for k in range(0, 180, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(len(rows) * 4, "doc_id")
    got = sorted((tuple(r) for r in substrings.remove_repeats(df).collect()), key=repr)
    assert got == brute(rows, 13)


def test_settled_rows_leave_a_common_passage(spark):
    """A passage of all texts brings a row per task to its key, and the result is the same."""
    rng = random.Random(12)
    passage = " ".join(f"w{k}" for k in range(30))
    rows = [(k, f"{rng.getrandbits(40)} {passage} {rng.getrandbits(40)}") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    made = df.mapInArrow(substrings._anchor_rows(substrings.WINDOW, substrings.ROUNDS),
                         "name long, doc long, state byte")
    dealt = made.repartition(16, substrings._dealt("name")).withColumn(
        "part", F.spark_partition_id())
    hot = dealt.groupBy("name").count().orderBy(F.desc("count")).first()
    assert hot["count"] > 300
    most = dealt.where(F.col("name") == hot["name"]).groupBy("part").count().agg(
        F.max("count")).first()[0]
    assert most < 0.25 * hot["count"]
    got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(df).collect()}
    assert got == {k: 30 if k else 0 for k in range(400)}
