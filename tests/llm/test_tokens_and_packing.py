import glob
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from coursemill.llm import packing, tokens

public = pytest.importorskip("public_tokenizers")


def documents(spark, count):
    rng = random.Random(count)
    rows = [(rng.randrange(10**9), rng.choice([None, "", " "]) if rng.random() < 0.1 else " ".join(
        rng.choice(["alpha", "beta,", "gamma.\n", "δ"]) for _ in range(rng.randint(1, 1500))), 1)
        for _ in range(count)]
    rows += [(7, "long " * 30_000, 1), (None, "no id", 1), (8, "twice", 1), (8, "twice", 1)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "doc_id long, text string, part int").repartition(3)


def encoded(text, name):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public.path(name))
    return [*made.encode(text or "", add_special_tokens=False).ids, 1]


def test_files_hold_the_ids_in_order(spark, folder):
    rows, df = documents(spark, 60)
    tokens.write(df, public.path("word_bpe_49k.json"), folder)
    got = [tuple(r) for r in tokens.read(spark, folder).select(
        "doc_id", "start", "n_tokens", "ids").orderBy("start").collect()]
    want, at = [], 0
    for doc, text, _ in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = encoded(text, "word_bpe_49k.json")
        want.append((doc, at, len(ids), ids))
        at += len(ids)
    assert got == want
    crc = {r.doc_id: r.ids_crc32 for r in tokens.checksums(tokens.raw(spark, folder)).collect()}
    assert all(crc[doc] == zlib.crc32(np.array(ids, "<u4").tobytes())
               for doc, _, _, ids in want)
    # The format: dictionary encoding and a page index in every file.
    for path in glob.glob(f"{folder}/*.parquet"):
        group = pq.ParquetFile(path).metadata.row_group(0)
        ids = group.column(group.num_columns - 1)
        assert "RLE_DICTIONARY" in ids.encodings or "PLAIN_DICTIONARY" in ids.encodings
        assert ids.has_offset_index and group.column(0).has_column_index


def test_no_documents_no_rows(spark, folder):
    _, df = documents(spark, 1)
    tokens.write(df.where("false"), public.path("word_bpe_49k.json"), folder)
    assert tokens.read(spark, folder).count() == 0
    assert packing.pack(packing.pieces(
        df.where("false"), public.path("byte_bpe_50k.json"))).count() == 0


def test_packing_keeps_every_id_once(spark):
    rows, df = documents(spark, 150)
    parts = packing.pieces(df, public.path("byte_bpe_50k.json"))
    packed = packing.pack(parts).collect()
    got = {}
    for r in packed:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert len(r.ids) == r.length
        got.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
    for doc, text, _ in rows:
        ids = encoded(text, "byte_bpe_50k.json")
        own = sorted(got[doc, len(ids)])
        if doc == 8:
            own = own[::2]
        assert [x for _, part in own for x in part] == ids
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        ends = [offset + length for offset, length in sorted(own)]
        assert [offset for offset, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 2048
    whole = packing.sequences(packing.pack(parts)).collect()
    assert sum(len(r.ids) for r in whole) == sum(r.length for r in packed)


def test_room_gives_the_tightest_fit():
    rng = random.Random(1)
    room, open_ = packing.Room(64), []
    for number in range(3000):
        length = rng.randint(1, 64)
        fits = [left for left, _ in open_ if left >= length]
        found = room.take(length)
        if not fits:
            assert found is None
            found = number, 64
        else:
            assert found[1] == min(fits)
            open_.remove((found[1], found[0]))
        if found[1] > length:
            room.put(found[1] - length, found[0])
            open_.append((found[1] - length, found[0]))


def test_little_padding(spark):
    rng = random.Random(2)
    rows = spark.createDataFrame(
        [(k, 0, rng.randint(1, 2048)) for k in range(20_000)], "doc_id long, start long, length long")
    got = packing.pack(rows.coalesce(1)).groupBy("sequence_id").sum("length").collect()
    assert sum(r[1] for r in got) > 0.98 * 2048 * len(got)
