import hashlib
import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from coursemill.llm import quality, simhash, toxicity

from .test_pii import brute as spans_of
from .test_simhash import closed

public = pytest.importorskip("public_tokenizers")
Tokenizer = pytest.importorskip("tokenizers").Tokenizer
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables")


def masked(text):
    out, at = [], 0
    names = ["email", "ip", "card", "phone"]
    for start, place, stop in spans_of(text):
        if start >= at:
            out += [text[at:start], f"<{names[place]}>"]
        at = max(at, stop)
    return "".join(out) + text[at:]


def mix(rows):
    """Brute force over (doc_id, text, source)."""
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.encode().split())
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))}
    target, left, free = dict.fromkeys(sizes, 0.0), 1.5 * sum(sizes.values()), set(sizes)
    while left > 1e-9:
        level = left / sum(weights[s] for s in free)
        full = {s for s in free if target[s] + level * weights[s] >= 2 * sizes[s]}
        if not full:
            for s in free:
                target[s] += level * weights[s]
            break
        for s in full:
            left -= 2 * sizes[s] - target[s]
            target[s] = 2 * sizes[s]
        free -= full
    out = []
    for source in sizes:
        budget = math.floor(target[source] + 1e-6)
        own = sorted((hashlib.md5(str(i).encode()).hexdigest(), i, t)
                     for i, t, s in rows if s == source)
        while budget > 0:
            for _, i, text in own:
                words = text.encode().split()
                if budget >= len(words) > 0:
                    out.append((i, text))
                elif words and budget > 0:
                    out.append((i, b" ".join(words[:budget]).decode()))
                budget -= min(budget, len(words))
    return Counter(out)


def test_stages_match_brute_force(spark, folder):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows, kept = docs, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = kept if name != "packing" else rows.collect()
        stage(spark, rows, FOLDER).write.parquet(f"{folder}/{name}")
        rows = spark.read.parquet(f"{folder}/{name}")
        if name != "packing":
            assert rows.columns == docs.columns
        if name == "toxicity":
            known = [i for i in labels if zlib.crc32(str(i).encode()) % 5]
            model = toxicity.fit(toxicity.Texts(
                [before[i].text for i in sorted(known) if labels[i]],
                [before[i].text for i in sorted(known) if not labels[i]]))
            values = model.probability(toxicity.text_scores(
                [r.text for r in before.values()], model.weights()))
            kept = {i: r for (i, r), p in zip(before.items(), values, strict=True) if p < 0.5}
            assert {r.doc_id for r in rows.collect()} == set(kept)
        elif name == "near_copies":
            least = closed({i: simhash.fingerprint(r.text.encode()) for i, r in before.items()}, 3)
            kept = {i: r for i, r in before.items() if least[i] == i}
            assert {r.doc_id for r in rows.collect()} == set(kept)
        elif name == "personal_data":
            kept = {r.doc_id: r for r in rows.collect()}
            assert {i: r.text for i, r in kept.items()} == {
                i: masked(r.text) for i, r in before.items()}
            assert all(r.n_chars == len(r.text) for i, r in kept.items()
                       if r.text != before[i].text)
        elif name == "mixing":
            got = Counter((r.doc_id, r.text) for r in rows.collect())
            assert got == mix([(r.doc_id, r.text, r.source) for r in before.values()])
        else:
            made = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
            ids = [np.array([*x.ids, 1], "<u4").tobytes() for x in made.encode_batch(
                [r.text for r in before], add_special_tokens=False)]
            want = Counter((r.doc_id, len(x) // 4) for r, x in zip(before, ids, strict=True))
            parts = rows.collect()
            assert Counter((r.doc_id, r.doc_tokens) for r in parts if r.start == 0) == want
            by_crc = {(r.doc_id, s, zlib.crc32(x[4 * s:4 * s + 8192]))
                      for r, x in zip(before, ids, strict=True)
                      for s in range(0, len(x) // 4, 2048)}
            assert {(r.doc_id, r.start, r.ids_crc32) for r in parts} == by_crc
            sequences = {}
            for r in parts:
                sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
            for own in sequences.values():
                at = 0
                for offset, length in sorted(own):
                    assert offset == at
                    at += length
                assert at <= 2048
    assert sorted(corpus_pipeline.run(spark, FOLDER).drop("sequence_id", "offset").collect()) == (
        sorted(rows.drop("sequence_id", "offset").collect()))


CLASHING = ["_kept", "_words", "_cut", "_row", "_source", "_key", "_range", "_of", "_in", "_start",
            "_before", "_pii_text", "_pii_all", "_pii_spans", "_pii_email", "score", "predicted",
            "size", "taken", "target", "spans", "fingerprint", "component_id", "a", "id", "value"]


def odd_documents(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with names in use."""
    texts = [(1, "one two three four five"), (1, "one two three four five"), (2, None), (3, ""),
             (None, "no id at all"), (None, None), (4, "mail a.b@c.de or call +49 (30) 1234567890"),
             (5, "long " * 100_000), (6, "one two three four five"), (7, " \n\t")]
    rows = [(i, t, None if k == 3 else "en", None if k % 4 == 0 else "s", k, *[f"{c}{k}" for c in (
        CLASHING)]) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                 "n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING))


def test_stages_handle_odd_tables(spark, folder):
    spark.createDataFrame([(1, 0, 0), (99, 0, 1)], "doc_id long, quality int, toxic int"
                          ).write.parquet(f"{folder}/labels.parquet")
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.schema == docs.schema, name
        path = f"{folder}/{name}"
        out.write.parquet(path)
        known = {tuple(r[5:]) for r in docs.collect()}
        docs = spark.read.parquet(path)
        # Whatever a stage keeps has the columns that it came with.
        assert {tuple(r[5:]) for r in docs.collect()} <= known, name
        assert stage(spark, docs.where("false"), folder).count() == 0
        if name == "near_copies":
            kept = [(r.doc_id, r.text) for r in docs.collect()]
            assert kept.count((1, "one two three four five")) == 2  # repeated rows stay together
            assert 6 not in [i for i, _ in kept]
            # Rows without an id stay, all of them, as one of them does.
            assert {i for i, t in kept if not (t or "").strip()} == {2, None}
        if name == "personal_data":
            assert "mail <email> or call <phone>" in [r.text for r in docs.collect()]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert sum(r.length for r in packed) > 100_000
    assert corpus_pipeline.STAGES[-1][1](spark, docs.where("false"), folder).count() == 0


def test_quality_keeps_columns_of_its_own_names(spark):
    df = spark.createDataFrame([("a b.", "mine", 1)], "text string, _q_text string, _q_words int")
    row = quality.measure(df).first()
    assert (row["_q_text"], row["_q_words"], row["n_words"]) == ("mine", 1, 2)
