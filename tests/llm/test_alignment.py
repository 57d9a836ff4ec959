import functools
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from coursemill.llm import alignment

public = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
BYTE, PIECE = "byte_bpe_50k.json", "piece_bpe_32k.model"


@functools.cache
def libraries():
    """Both tokenizers, and the byte that each letter of the first one stands for."""
    from tokenizers import Tokenizer, pre_tokenizers

    one = Tokenizer.from_file(public.path(BYTE))
    one.encode_special_tokens = True
    # What the library itself shows for bytes: of characters with every lead and tail byte.
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    codes = [*range(0x800), *range(0x800, 0xD800, 0x800), 0xE000, 0xF000,
             *range(0x10000, 0x110000, 0x10000)]
    letters = {
        name: byte for code in codes for shown in [level.pre_tokenize_str(chr(code))[0][0]]
        for name, byte in zip(shown, chr(code).encode(), strict=True)}
    return one, sentencepiece.SentencePieceProcessor(model_file=public.path(PIECE)), letters


def tokens(text):
    """Both tokenizations of a text as (id, bytes), or None."""
    one, two, letters = libraries()
    a = [(i, bytes(letters[c] for c in one.id_to_token(i)))
         for i in one.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i)
          else two.id_to_piece(i).replace("▁", " ").encode()) for i in two.encode(text)]
    full = (" " + text).encode()
    if b"".join(x for _, x in a) != full or b"".join(x for _, x in b) != full:
        return None
    return a, b


def brute(docs):
    held, out = defaultdict(set), []
    for row, (doc, text) in enumerate(docs):
        found = tokens(text) if text else None
        if not found:
            out.append((doc, 0, 0, 0, [], ""))
            continue
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in found]
        groups, links, at = [], [], [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            group = []
            for k in (0, 1):
                group.append([])
                while at[k] < len(ends[k]) and ends[k][at[k]] <= cut:
                    group[k].append(found[k][at[k]][0])
                    at[k] += 1
            groups.append("|".join(",".join(map(str, g)) for g in group))
            links += [(x, y) for x in group[0] for y in group[1]]
        for link in set(links):
            held[link].add(row)
        out.append((doc, len(found[0]), len(found[1]), len(groups), links,
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = Counter()
    for (a, _), rows in held.items():
        top[a] = max(top[a], len(rows))
    return sorted(((doc, a, b, groups, len(links), sum(len(held[x]) == top[x[0]] for x in links),
                    sum(len(held[x]) for x in links), digest)
                   for doc, a, b, groups, links, digest in out), key=repr), held


def documents():
    rng = random.Random(2)
    parts = ["the", "a", " ", " ", "é", "日本", "😀", "ing", "\n", ".", "x", " ", "▁", "<s>",
             "<|endoftext|>", "  ", " of", " and", "ü", "<0x0A>", "\xa0"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randrange(40)))) for k in range(200)]
    rows += [(1000, None), (None, "x y"), (7, ""), (7, " "), (8, "the " * 5000), (9, "日" * 3000),
             (10, "a" * 600), (11, "😀é" * 500), (12, "twice"), (12, "twice")]
    # Enough documents with one pair for containers of bits, and several planes.
    return rows + [(2000 + k, "the " + "the " * (k % 6) + "x of") for k in range(700)]


@pytest.mark.parametrize("parts", [1, 3])
def test_matches_brute_force(spark, parts):
    rows = documents()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows],
                               "doc_id long, text string, block int, n string").repartition(parts)
    found = alignment.align(df, public.path(BYTE), public.path(PIECE))
    want, _ = brute(rows)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want


def test_bitmaps_hold_documents_and_links(spark):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = alignment.postings(df, public.path(BYTE), public.path(PIECE)).cache()
    _, held = brute(rows)
    counted = {(r.a, r.b): (r["count"], r.top) for r in alignment.counts(found).collect()}
    assert {k: c for k, (c, _) in counted.items()} == {k: len(v) for k, v in held.items()}
    links = sum(r.n_links for r in alignment.counts(found).collect())
    assert links == found.where("plane = -1").agg({"n_links": "sum"}).first()[0]
    for r in found.where("plane >= 0").collect():
        own = alignment.documents_of(bytes(r.docs), r.n)
        assert len(own) == r.n and (np.diff(own) > 0).all()
        assert len(r.docs) <= alignment.BLOCK // 8


def test_large_groups_are_counted():
    made = alignment.Aligner(public.path(BYTE), public.path(PIECE))
    a = np.array([5, 5, 7] * 200)
    b = np.array([1, 2, 2, 2] * 200)
    # 600 tokens of 4 bytes over 800 of 3 have an end in common every 12 bytes.
    made.one_sizes, made.two_sizes = np.full(10, 4), np.full(10, 3)
    every, = made._align([a], [b])
    assert every.counted is None and every.sizes == (600, 800, 200)
    keys, counts = alignment.Aligner._counted(a, b)
    want = Counter((int(x) << alignment.ID_BITS | int(y)) for x in a for y in b)
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == want
    block = alignment._Block(0)
    block.docs = 2
    block.keys = [keys[:1] * alignment.BLOCK]
    block.counted = [(keys * alignment.BLOCK, counts), (keys * alignment.BLOCK + 1, counts)]
    rows = [r for batch in block.postings() for r in batch.to_pylist()]
    total = Counter()
    for r in rows:
        total[r["a"] << alignment.ID_BITS | r["b"]] += r["n"] * (2 ** max(r["plane"] - 1, 0))
    assert total == Counter({k: 2 * c for k, c in want.items()}) + Counter({int(keys[0]): 1})


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(df, public.path(BYTE), public.path(PIECE)).count() == 0
