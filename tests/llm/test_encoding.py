import os
import random

import pyarrow as pa
import pytest

from coursemill.llm import encoding, pieces

public = pytest.importorskip("public_tokenizers")
ODD = ["", " ", "  ", "a  b", " a", "a ", "a \n b\n\n c", "\x1c a\x1cb c", " ́x é é",
       "<|endoftext|> x <|endoftext|>", "it's  don't 's", "ΑΣ ΟΔΟΣ a", "12 345,6 7",
       " .. !! ?a", "foo.\nBar, a.\nb, é,", "a,́ b.\nc'", "x²,\ny2.", " a   b", "\U0001f600 \U0001f600."]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_one_call_per_text(name, monkeypatch):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    monkeypatch.setattr(encoding, "KEPT_PIECES", 50)
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab '\n\t.,,.1éé  \x1c<|>_") for _ in range(30))
                   for _ in range(3000)]
    made = encoding.Encoder(public.path(name))
    got = []
    for at in range(0, len(texts), 100):
        values, bounds = made.ids(pa.array(texts[at:at + 100]), 1)
        got += [values[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
    for text, ids in zip(texts, got, strict=True):
        want = made.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == [*want, 1], repr(text)


def test_pieces_join_to_the_texts():
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("ab \n\t\x0b\x1c\x85\xa0\u1680\u2003\u3000") for _ in range(
        rng.randrange(12))) for _ in range(4000)] + [None]
    cut = pieces.cut(pa.array(texts))
    got = [[cut.words[k] for k in cut.of[a:b]]
           for a, b in zip(cut.bounds, cut.bounds[1:], strict=False)]
    assert len(set(cut.words)) == len(cut.words)
    for text, words in zip(texts, got, strict=True):
        assert "".join(map(pieces.raw, words)) == (text or "")
        assert all(a == "" or not a[-1].isspace() and b[0] == " " and not b[1:2].isspace()
                   for a, b in zip(map(pieces.raw, words), map(pieces.raw, words[1:]),
                                   strict=False))


def test_no_texts():
    made = encoding.Encoder(public.path("byte_bpe_50k.json"))
    values, bounds = made.ids(pa.array([], pa.string()), 1)
    assert len(values) == 0 and bounds.tolist() == [0]
