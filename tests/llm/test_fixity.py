import gzip
import hashlib
import os
import random
from collections import Counter

import duckdb
import pytest

from check import canonical
from coursemill.llm import fixity

PAGES = "page_id long, url string, html string, record string, replica int"
COLUMNS = ("file", "record_id", "is_record", "offset", "length", "digest", "state")


def pages(count, rng):
    return [(i, rng.choice([None, f"http://x/{i}"]),
             rng.choice([None, "", "é\r\n\r\nWARC/1.1\r\n" * rng.randint(1, 9), "<p>" * i]), "k", 1)
            for i in range(count)]


def content(spark, folder):
    """Plain bytes of the files below a folder."""
    return {int(r.path.split("file=")[1].split("/")[0]): gzip.decompress(bytes(r.content))
            for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
                folder).collect()}


def put(folder, replica, files):
    for number, data in files.items():
        place = f"{folder}/replica={replica}/file={number}"
        os.makedirs(place)
        with open(f"{place}/part.gz", "wb") as file:
            file.write(gzip.compress(data))


@pytest.fixture
def one(spark, folder):
    """A file of six records, as bytes and cut into them."""
    rows = spark.createDataFrame([(k, f"u{k}", f"body {k} " * (k + 1), "x", 1) for k in range(6)], PAGES)
    fixity.write(fixity.records(rows), f"{folder}/made")
    data = content(spark, f"{folder}/made")[0]
    parts, at = [], 0
    while at < len(data):
        stop = data.find(b"WARC/1.1", at + 1)
        stop = len(data) if stop < 0 else stop
        parts.append(data[at:stop])
        at = stop
    assert b"".join(parts) == data and len(parts) == 6
    return parts


DAMAGE = {
    "none": lambda p: p,
    "byte": lambda p: [*p[:2], p[2].replace(b"body", b"bodx", 1), *p[3:]],
    "lost": lambda p: [*p[:2], *p[3:]],
    "swapped": lambda p: [p[0], p[2], p[1], *p[3:]],
    "stray": lambda p: [*p[:3], b"stray", *p[3:]],
    "stray at the end": lambda p: [*p, b"WARC/1.1\r\n"],
    "header": lambda p: [*p[:2], p[2].replace(b"WARC/1.1", b"WARC/9.9"), *p[3:]],
    "length": lambda p: [*p[:2], p[2].replace(b"Content-Length: ", b"Content-Length: 7"), *p[3:]],
    "no length": lambda p: [*p[:2], p[2].replace(b"Content-Length: ", b"Content-Length: x"), *p[3:]],
    "cut off": lambda p: [*p[:5], p[5][:-9]],
    "twice": lambda p: [*p[:3], p[2], *p[3:]],
    "empty": lambda p: [],
}


@pytest.mark.parametrize("kind", sorted(DAMAGE))
@pytest.mark.parametrize("fanout", [2, 16])
def test_each_kind_of_damage_is_located(spark, folder, one, kind, fanout):
    damaged = DAMAGE[kind](one)
    put(folder + "/r", 0, {0: b"".join(one)})
    put(folder + "/r", 1, {0: b"".join(damaged)})
    got = {(r.record_id, r.is_record, r.offset, r.state): r for r in fixity.audit(
        fixity.read(spark, folder + "/r"), fanout).collect()}
    starts = [sum(map(len, one[:k])) for k in range(7)]

    def unlike(k, state):
        return (k, True, starts[k], state)

    moved = {"byte": [], "none": [], "stray": [3, 4, 5], "lost": [3, 4, 5], "swapped": [1, 2],
             "twice": [3, 4, 5], "length": [3, 4, 5], "no length": [3, 4, 5]}.get(kind, [])
    want = {unlike(k, "intact") for k in range(6)}
    changes = {
        "byte": {2: "changed"}, "lost": {2: "missing"}, "header": {2: "missing"},
        "length": {2: "missing"}, "no length": {2: "missing"}, "cut off": {5: "missing"},
        "empty": dict.fromkeys(range(6), "missing")}.get(kind, {})
    for k, state in {**dict.fromkeys(moved, "moved"), **changes}.items():
        want = {w for w in want if w[0] != k} | {unlike(k, state)}
    extra = {"stray": [(None, False, starts[3], "extra")],
             "stray at the end": [(None, False, starts[6], "extra")],
             "header": [(None, False, starts[2], "extra")],
             "length": [(None, False, starts[2], "extra")],
             "no length": [(None, False, starts[2], "extra")],
             "cut off": [(None, False, starts[5], "extra")],
             "twice": [(2, True, sum(map(len, damaged[:3])), "extra")]}.get(kind, [])
    assert set(got) == want | set(extra)
    files = {0: b"".join(one), 1: b"".join(damaged)}
    for (_, _, offset, state), row in got.items():
        data = files[1 if state == "extra" else 0]
        assert hashlib.sha256(data[offset:offset + row.length]).hexdigest() == row.digest


def test_files_hold_every_byte_and_record(spark, folder):
    rng = random.Random(2)
    rows = fixity.records(spark.createDataFrame(pages(40, rng), PAGES), 9)
    fixity.write(rows, folder)
    files = content(spark, folder)
    found = fixity.read(spark, folder, with_content=True).collect()
    assert all(r.is_record for r in found)
    for number, data in files.items():
        own = sorted((r.offset, bytes(r.content)) for r in found if r.file == number)
        assert b"".join(part for _, part in own) == data
        assert [at for at, _ in own] == [sum(len(p) for _, p in own[:k]) for k in range(len(own))]
    assert sorted((r.file, r.record_id, bytes(r.content).decode()) for r in found) == sorted(
        (r.file, r.record_id, r.record + fixity.END) for r in rows.collect())


def test_pages_without_an_id_are_dealt_to_bounded_files(spark, folder):
    rows = [(None, None, None, None, 1), (None, None, None, None, 1), (1, None, "b", None, 1),
            (1, None, "b", None, 1), (1, None, "c", None, 1), (2, "u", "long " * 200_000, None, 1),
            *[(None, f"u{k}", f"page {k}", None, 1) for k in range(60)]]
    made = fixity.records(spark.createDataFrame(rows, PAGES), 10)
    sizes = Counter(r.file for r in made.where("record_id IS NULL").collect())
    assert min(sizes) >= -7 and max(sizes) < 0 and max(sizes.values()) < 30
    both = made.crossJoin(spark.createDataFrame([(0,), (1,)], "replica int"))
    fixity.write(both, folder)
    got = fixity.audit(fixity.read(spark, folder)).collect()
    assert len(got) == len(rows) and {r.state for r in got} == {"intact"}
    only = fixity.read(spark, folder).where("replica = 0")
    assert [r.state for r in fixity.audit(only).collect()] == ["missing"] * len(rows)
    other = fixity.read(spark, folder).where("replica = 1")
    assert [r.state for r in fixity.audit(other).collect()] == ["extra"] * len(rows)
    assert fixity.audit(only.where("false")).count() == 0


def test_query_on_odd_pages_matches_sql(spark, folder):
    """Also where damaged pages are neighbours, and stretches between records join."""
    rng = random.Random(3)
    rows = pages(2500, rng) + [(None, f"u{k}", f"<p>{k}", "k", 1) for k in range(900)]
    spark.createDataFrame(rows, PAGES).write.parquet(f"{folder}/pages.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    got = canonical(fixity.query(spark, folder).select(*COLUMNS).collect())
    assert got == canonical(db.sql(fixity.SQL).fetchall())
    assert {r[-1] for r in got} >= {"intact", "moved", "changed", "missing", "extra"}
