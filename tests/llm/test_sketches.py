import hashlib
import random
import re

import numpy as np
import pytest

from coursemill.llm import sketches


def shingles(text):
    """Word shingles of a text, by the rule alone."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode())
    return {b" ".join(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def alike(one, two):
    if not one or not two:
        return float(one == two)
    return len(one & two) / min(len(one), len(two))


def brute(rows):
    """(n_chars, digest, exact containment in the edited and in the next text) by id."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        one, two, three = map(shingles, (text, edited, after))
        out[doc] = (len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    alike(one, two), alike(one, three), len(one), edited)
    return out


def test_a_sketch_is_a_fixed_share_of_the_shingles():
    """Membership depends on the shingle alone, and equal shingles have one hash."""
    rng = random.Random(9)
    kept, dropped = {}, set()
    for _ in range(600):
        words = [rng.choice("ab cd é f".split()) for _ in range(rng.randint(1, 5))]
        text = " ".join(words)
        got = sketches.sketch(text)
        assert len(got) <= 1  # at most five words: one shingle
        (kept.setdefault(text, got[0]) if len(got) else dropped.add(text))
    assert not set(kept) & dropped and 0.6 < len(kept) / (len(kept) + len(dropped)) < 0.9
    assert len(set(kept.values())) == len(kept)
    assert max(kept.values()) < 0.75 * 2 ** 32
    # The sketch of a text is the union of those of its shingles, whatever its length.
    words = [str(rng.getrandbits(20)) for _ in range(300)]
    whole = set(sketches.sketch(" ".join(words)).tolist())
    parts = {h for k in range(296) for h in sketches.sketch(" ".join(words[k:k + 5])).tolist()}
    assert whole == parts


def test_hashes_spread_over_the_whole_range():
    rng = random.Random(10)
    got = sketches.sketch(" ".join(str(rng.getrandbits(40)) for _ in range(40_000)))
    share = np.histogram(got, 8, (0, 0.75 * 2 ** 32))[0] / len(got)
    assert abs(len(got) / 39_996 - 0.75) < 0.02 and abs(share - 1 / 8).max() < 0.01


@pytest.mark.parametrize("words,error", [((6, 20), 0.16), ((20, 60), 0.08), ((60, 400), 0.04)])
def test_error_by_length(words, error):
    rng, off = random.Random(words[0]), []
    for _ in range(300):
        text, after = (" ".join(str(rng.getrandbits(30)) for _ in range(rng.randint(*words)))
                       for _ in range(2))
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        near, _ = sketches.likeness(sketches.sketch(text), sketches.sketch(edited))
        off.append(abs(near - alike(shingles(text), shingles(edited))))
    assert np.mean(off) < error


@pytest.mark.parametrize("count", [0, 1, 2, 150])
def test_rows_match_brute_force(spark, count):
    rng = random.Random(count)
    rows = [(rng.randint(0, 10) + 11 * k, rng.choice([None, "", " ", "é a 😀 b"])
             if rng.random() < 0.2 else " ".join(
                 rng.choice("ab cd éf 😀 gh ij".split()) for _ in range(rng.randint(1, 300))))
            for k in range(count)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows],
                               "doc_id long, text string, fingerprint int").repartition(3)
    got = {r.doc_id: r for r in sketches.compare_with_edited(df).collect()}
    want = brute(rows)
    assert {i: (r.n_chars, r.edited_sha256) for i, r in got.items()} == {
        i: w[:2] for i, w in want.items()}
    off = []
    for i, r in got.items():
        assert r.edited_fingerprint == sketches.as_text(sketches.sketch(want[i][5]))
        off += [abs(r.near_edited - want[i][2]), abs(r.near_next - want[i][3])]
    assert not off or np.mean(off) < 0.1


def test_repeated_and_missing_ids_lose_no_row(spark, monkeypatch):
    rows = [(None, "a"), (None, "a"), (5, "b"), (5, "b"), (5, None), (7, "c"),
            (9, "long " * 200_000), *[(None, f"text {k}") for k in range(40)]]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows],
                               "doc_id long, text string, place int, tie int")
    alone = df.where("doc_id IS NULL")
    whole = sketches.compare_with_edited(df).collect()
    assert sorted([r.doc_id for r in whole], key=repr) == sorted([r[0] for r in rows], key=repr)
    # Rows without an id are dealt to as many ranges as they need; each still meets the next one.
    want = sorted(r.edited_sha256 for r in sketches.compare_with_edited(alone).collect())
    monkeypatch.setattr(sketches, "RANGE_BYTES", 16)
    got = sorted(r.edited_sha256 for r in sketches.compare_with_edited(alone).collect())
    assert got == want and len(got) == 42
    monkeypatch.setattr(sketches, "RANGE_BYTES", 1 << 17)
    assert sorted(r.edited_sha256 for r in sketches.compare_with_edited(df).collect()) == sorted(
        r.edited_sha256 for r in whole)


def test_estimates_are_near_the_truth():
    rng = random.Random(4)
    words = [str(rng.getrandbits(40)) for _ in range(40_000)]
    whole, part = " ".join(words), " ".join(words[5_000:9_000])
    contained, jaccard = sketches.likeness(sketches.sketch(whole), sketches.sketch(part))
    assert contained == 1 and abs(jaccard - 0.1) < 0.02
    half = " ".join(words[:2_000] + [str(rng.getrandbits(40)) for _ in range(2_000)])
    assert abs(sketches.likeness(sketches.sketch(half), sketches.sketch(whole))[0] - 0.5) < 0.06
    two = sketches.merged(sketches.sketch(part), sketches.sketch(half))
    assert set(two) == set(sketches.sketch(part)) | set(sketches.sketch(half))
    assert np.array_equal(sketches.from_text(sketches.as_text(two)), two)
