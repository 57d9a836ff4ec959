import base64
import hashlib
import random

import pyarrow as pa
import pytest
import regex

from coursemill.llm import bytebpe

public = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
NAMES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]
RNG = random.Random(1)
TEXTS = ["", " ", "  ", "a  b", " a", "a ", "it's  don't 's 'll", "<|endoftext|> x", "\x00 \x1c a",
         *["a" * n for n in range(1, 400, 23)], *[" " * n + "x" for n in range(1, 300, 31)],
         "=-" * 500, "thethethe" * 200, "日本" * 300, "é́ ́x", "\U0001f600 \U0001f600.",
         *["".join(RNG.choice("ab e'strthe \n\t..,,11éüß  —日本😀ААаг\x00==")
                   for _ in range(RNG.randrange(60))) for _ in range(1500)]]


def library(name):
    with open(public.path(name), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@pytest.mark.parametrize("name", NAMES)
def test_ids_equal_the_library(name, monkeypatch):
    monkeypatch.setattr(bytebpe, "KEPT", 200)
    monkeypatch.setattr(bytebpe, "BATCH", 100)
    made = library(name)
    coder = bytebpe.Coder(public.path(name), public.PATTERN)
    for at in range(0, len(TEXTS), 300):
        some = TEXTS[at:at + 300]
        values, bounds = coder.encode(pa.array(some))
        for k, text in enumerate(some):
            assert values[bounds[k]:bounds[k + 1]].tolist() == made.encode_ordinary(text), text


def test_every_prefix_has_the_last_token_of_its_encoding():
    made = library(NAMES[0])
    vocabulary = bytebpe.Vocabulary.read(public.path(NAMES[0]))
    for word in (" unbelievable", "aaaaaaaaaaaaa", "=-=-=-=", " Ångström", "12345678"):
        data = word.encode()
        want = [made._encode_single_piece(data[:k])[-1] for k in range(1, len(data) + 1)]
        assert vocabulary.extend(data, []) == want
        assert vocabulary.last_tokens([data, data])[0].tolist() == want * 2


def test_edits_equal_encoding_anew():
    """Also that what an edit costs does not grow with the text."""
    made = library(NAMES[0])
    vocabulary = bytebpe.Vocabulary.read(public.path(NAMES[0]))
    pattern = regex.compile(public.PATTERN)
    rng = random.Random(3)
    for text in rng.choices(TEXTS, k=250):
        edited = bytebpe.Text(vocabulary, pattern, text)
        for _ in range(3):
            start = rng.randrange(len(text) + 1)
            stop = min(len(text), start + rng.randrange(4))
            new = "".join(rng.choice("ab' st\n1é=") for _ in range(rng.randrange(4)))
            edited.replace(start, stop, new)
            text = text[:start] + new + text[stop:]
            assert "".join(edited.parts) == text
            assert edited.ids() == made.encode_ordinary(text)
            assert edited.last == bytebpe.Text(vocabulary, pattern, text).last
    # An edit in a long text costs its surroundings, in a long match too.
    long_ = bytebpe.Text(vocabulary, pattern, "word " * 20_000 + "ab" * 3_000)
    long_.replace(50_001, 50_002, "xy")
    assert 0 < long_.encoded < 60
    long_.replace(103_000, 103_001, "xyz")
    assert 0 < long_.encoded < 400
    long_.append("c d")
    assert long_.encoded < 6_100
    assert long_.ids() == made.encode_ordinary("".join(long_.parts))


def test_tokens_that_no_merge_makes():
    """A match that is such an entry as a whole is that entry; within a match it never is."""
    ranks = {bytes([k]): k for k in range(256)} | {b"ab": 256, b"xyz": 257}
    made = tiktoken.Encoding("own", pat_str=r"\w+|\W+", mergeable_ranks=ranks, special_tokens={})
    vocabulary = bytebpe.Vocabulary(ranks)
    words = ["xyz", "xyzab", "abxyz", "ababx", "xy"]
    got = vocabulary.encode_words([w.encode() for w in words])
    for word, ids in zip(words, got, strict=True):
        assert pa.array([ids]).cast(pa.binary())[0].as_py() == b"".join(
            k.to_bytes(4, "little") for k in made.encode_ordinary(word))


def test_operators_on_tables(spark, folder):
    path, made = public.path(NAMES[0]), library(NAMES[0])
    rows = [(k, t, "own", 1) for k, t in enumerate(TEXTS[:60])]
    rows += [(None, "no id", "x", 1), (7, None, "x", 1), (8, "twice", "x", 1), (8, "twice", "x", 1),
             (9, "long " * 60_000, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    found = bytebpe.decode(bytebpe.encode(docs.repartition(3), path, public.PATTERN), path,
                           public.PATTERN)
    assert found.columns == ["doc_id", "ids", "decoded"]
    want = sorted((str(i), b"".join(k.to_bytes(4, "little") for k in made.encode_ordinary(t or "")),
                   (t or "").encode()) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded)) for r in found.collect()) == want
    assert bytebpe.encode(docs.where("false"), path, public.PATTERN).count() == 0
    docs.write.parquet(f"{folder}/documents.parquet")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
           for r in bytebpe.query(spark, folder).collect()}
    assert got == {(None if i == "None" else int(i), len(x) // 4, hashlib.sha256(x).hexdigest(),
                    hashlib.sha256(t).hexdigest()) for i, x, t in want}


def test_stored_tables_are_revised(spark, folder):
    path, made = public.path(NAMES[0]), library(NAMES[0])
    texts = {k: t for k, t in enumerate(TEXTS[:40])}
    docs = spark.createDataFrame([(k, t, 0) for k, t in texts.items()],
                                 "doc_id long, text string, start int")
    bytebpe.tables(docs, path, public.PATTERN).write.parquet(folder)
    edits = spark.createDataFrame([(3, 1, 2, "xy"), (10, 0, 0, "begin "), (99, 0, 0, "x"),
                                   (None, 0, 0, "x")], "doc_id long, start int, stop int, new string")
    got = {r.doc_id: r for r in bytebpe.revise(
        spark.read.parquet(folder), edits, path, public.PATTERN).collect()}
    texts[3] = texts[3][:1] + "xy" + texts[3][2:]
    texts[10] = "begin " + texts[10]
    assert {k: r.text for k, r in got.items()} == texts
    assert all(r.ids == made.encode_ordinary(r.text) for r in got.values())
    assert {k for k, r in got.items() if r.encoded} == {3, 10}


def test_one_worker_a_core_encodes_and_decodes(spark):
    """Two Python steps in a stage would be two workers a core, each with its own coder."""
    plan = bytebpe.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    assert plan.toString().count("MapInArrow") == 1
    path = public.path(NAMES[0])
    docs = spark.createDataFrame([(1, "a  b é", b"x"), (2, None, b"y"), (None, "it's", b"z")],
                                 "doc_id long, text string, decoded binary")
    both = bytebpe.encode(docs, path, public.PATTERN, decoded=True)
    two = bytebpe.decode(bytebpe.encode(docs.drop("decoded"), path, public.PATTERN), path,
                         public.PATTERN)
    assert both.columns == two.columns and sorted(map(str, both.collect())) == sorted(
        map(str, two.collect()))
