import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from coursemill.llm import links, simhash


def brute(rows):
    prints = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        parts = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        prints[doc] = sum(1 << b for b in range(64)
                          if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return prints, closed(prints)


def closed(prints, distance=3, seconds=None, second_distance=64):
    """Least id in reach of each id."""
    ids, values = list(prints), np.array(list(prints.values()), np.uint64)
    other = np.array([(seconds or dict.fromkeys(ids, 0))[i] for i in ids], np.uint64)
    least = dict(zip(ids, ids, strict=True))
    while True:
        low = np.array([least[i] for i in ids])
        new = {i: min(least[i], low[(np.bitwise_count(values ^ v) <= distance) & (
                   np.bitwise_count(other ^ w) <= second_distance)].min())
               for i, v, w in zip(ids, values, other, strict=True)}
        if new == least:
            return least
        least = new


def test_groups_match_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"),
            (7, "one two three"), (8, "ONE TWO THREE"), (9, "É é"), (10, "x " * 5000)]
    base = [rng.choice(words) for _ in range(300)]
    for doc in range(11, 160):
        text = list(base if doc % 3 else [rng.choice(words) for _ in range(rng.randint(1, 400))])
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((doc, rng.choice([" ", "\n", "\x0b "]).join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    prints, least = brute(rows)
    got = {r.doc_id: r for r in simhash.groups(df).collect()}
    assert {i: r.fingerprint % (1 << 64) for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == least
    assert len(set(least.values())) < len(least) - 20


@pytest.mark.parametrize("tile", [4, 64, 2048])
def test_hot_blocks_lose_no_link(spark, tile):
    rng = random.Random(2)
    centre, values = rng.getrandbits(64), set()
    while len(values) < 400:
        value = centre
        for _ in range(rng.randint(0, 9)):
            value ^= 1 << rng.randrange(64)
        values.add(value)
    prints = dict(enumerate(sorted(values)))
    signed = {i: v - (1 << 64) if v >> 63 else v for i, v in prints.items()}
    df = spark.createDataFrame(list(signed.items()), "id long, fingerprint long").withColumn(
        "second", F.lit(0).cast("long"))
    found = {r.node: r.component for r in links.components(
        simhash.links(df, tile=tile)).collect()}
    least = closed(prints)
    assert {i: found.get(i, i) for i in prints} == least


def test_wider_links_with_a_second_fingerprint(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(80)]
    base = [[rng.choice(words) for _ in range(rng.randint(40, 200))] for _ in range(15)]
    rows = []
    for doc in range(220):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 9)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((doc, " ".join(text)))
    one, two = ({i: simhash.fingerprint(t.encode(), k) for i, t in rows} for k in (3, 5))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.groups(
        df, distance=6, blocks=8, second=5, second_distance=14, tile=16).collect()}
    assert got == closed(one, 6, two, 14)
    assert len(set(got.values())) < 215


def test_components_of_paths(spark):
    rng = random.Random(3)
    order = list(range(200))
    rng.shuffle(order)
    pairs = list(zip(order[:120], order[1:121], strict=True)) + [(500, 501), (501, 500), (7, 7)]
    got = {r.node: r.component for r in links.components(
        spark.createDataFrame(pairs, "a long, b long")).collect()}
    low = min(order[:121])
    assert {got[i] for i in order[:121]} == {low} and got[501] == got[500] == 500
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_nulls_repeats_and_extra_columns(spark):
    df = spark.createDataFrame(
        [(None, "a b c", 1), (3, "a b c", 2), (3, "a b c", 2), (None, "z", 3)],
        "doc_id long, text string, fingerprint long")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.groups(df).collect()), key=repr)
    assert got == sorted([(None, 3), (3, 3), (3, 3), (None, None)], key=repr)
    assert simhash.groups(df.where("false")).count() == 0
    assert simhash.representatives(df).columns == df.columns
