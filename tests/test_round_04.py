"""What the review of the fourth round found."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from coursemill.plans import standins
from coursemill.streaming import carried, kept

from .conftest import rows

SF = "/root/testdata/sf0.001"
LINE, HEADER, VIEW = ("order_id string, line int", "_order_id string, session_id string, head int",
                      "_sid string, view int")
ORDERS, SESSIONS = ["o1", "o2", "o3", None], ["s1", "s2", None]


def writer(spark, folder, **options):
    """Rows of the three kinds come as one table that holds a struct of each."""
    schemas = [spark.createDataFrame([], kind).schema for kind in (LINE, HEADER, VIEW)]
    names = ("l", "h", "v")
    batch = spark.createDataFrame([], f"l struct<{LINE}>, h struct<{HEADER}>, v struct<{VIEW}>").schema
    write = carried.order_detail_writer(
        f"{folder}/out", f"{folder}/waiting",
        lambda df: [df.where(F.col(n).isNotNull()).select(f"{n}.*") for n in names],
        lambda df: df.select("line", "head", "view"), schemas, buckets=2, **options)
    return lambda data, number: write(spark.createDataFrame(data, batch), number)


def expected(batches, times, ttl):
    """A line and its header meet while one waits; the two wait for a view from then on."""
    placed = [[(t, row[kind]) for t, batch in zip(times, batches, strict=True) for row in batch
               if row[kind]] for kind in range(3)]
    found = []
    for (a, line), (b, head), (c, view) in itertools.product(*placed):
        met = (line[0] is not None and line[0] == head[0] and abs(a - b) <= ttl
               and head[1] is not None and head[1] == view[0])
        if met and abs(max(a, b) - c) <= ttl:
            found.append((line[1], head[2], view[1]))
    return sorted(found)


@pytest.mark.parametrize("seed", range(2))
def test_three_inputs_meet_within_their_times(spark, folder, monkeypatch, seed):
    monkeypatch.setattr(kept, "FOLD", 3)
    monkeypatch.setattr(carried, "PLACES", 128)  # keys share places
    rng, number, batches, times, clock = random.Random(seed), itertools.count(), [], [], [0]
    for _ in range(6):
        batches.append([rng.choice([
            ((rng.choice(ORDERS), next(number)), None, None),
            (None, (rng.choice(ORDERS), rng.choice(SESSIONS), next(number)), None),
            (None, None, (rng.choice(SESSIONS), next(number)))]) for _ in range(6)])
        times.append((times[-1] if times else 0) + rng.randrange(50, 110))
    write = writer(spark, folder, ttl_ms=100, clock=lambda: clock[0], reread=bool(seed))
    for k, (data, now) in enumerate(zip(batches, times, strict=True)):
        clock[0] = now
        for _ in range(2 if k == 3 else 1):  # a replay changes nothing
            write(data, k)
    assert expected(batches, times, 100)
    assert rows(spark.read.parquet(f"{folder}/out"), "line", "head", "view") == sorted(
        expected(batches, times, 100), key=repr)


def test_a_view_may_come_after_twice_the_time_of_the_header(spark, folder):
    """The line keeps its header for the view; a view that comes as late without the line does not."""
    clock = [0]
    write = writer(spark, folder, ttl_ms=100, clock=lambda: clock[0])
    write([(None, ("o1", "s1", 1), None), (None, ("o2", "s2", 2), None)], 0)
    clock[0] = 90
    write([(("o1", 3), None, None)], 1)
    clock[0] = 180
    write([(None, None, ("s1", 4)), (None, None, ("s2", 5)), (("o2", 6), None, None)], 2)
    assert rows(spark.read.parquet(f"{folder}/out"), "line", "head", "view") == [(3, 1, 4)]


def test_what_makes_no_new_pair_is_not_joined(spark):
    """Old rows without a new partner, and new ones without any, stay out of the shuffle."""
    lines = spark.createDataFrame(
        [(f"k{n}", n < 50) for n in range(100)], "k string, fresh boolean")
    others = spark.createDataFrame(
        [(f"k{n}", n % 10 == 0) for n in range(0, 100, 5)], "_k string, new boolean")
    left = carried.may_meet(lines, "k", "fresh", others, "_k", "new")
    assert left.columns == lines.columns
    assert rows(left, "k") == sorted(
        (f"k{n}",) for n in range(100) if n % 5 == 0 and (n < 50 or n % 10 == 0))


def test_rows_of_many_lines_are_kept_once_and_unshuffled(spark, folder, monkeypatch):
    """Lines are written as they come, not a second time with their header, and what met as it is joined."""
    plans, placed = [], []
    write_batch, place = carried.write_batch, kept.KeptTable._place
    monkeypatch.setattr(kept, "FILE_ROWS", 1)
    monkeypatch.setattr(carried, "write_batch", lambda df, *a, **k: plans.append(k) or write_batch(
        df, *a, **k))
    monkeypatch.setattr(kept.KeptTable, "_place", lambda table, df, *a: placed.append(
        (table, df.columns)) or place(table, df, *a))
    data = [((f"o{n}", n), None, None) for n in range(400)] + [
        (None, (f"o{n}", f"s{n}", n), None) for n in range(400)] + [
        (None, None, (f"s{n}", n)) for n in range(400)]
    writer(spark, folder, ttl_ms=100)(data, 0)
    assert spark.read.parquet(f"{folder}/out").count() == 400
    assert sum("line" in columns for _, columns in placed) == 1
    assert plans == [{"run": "", "rebalance": False}]
    files = {path: len(spark.read.parquet(f"{folder}/waiting/orders/{path}/rows").inputFiles())
             for path in ("left", "right")}
    assert files["left"] > files["right"] == 2


def test_order_facts_come_in_turn_without_a_shuffle(spark, folder, monkeypatch):
    written = []
    monkeypatch.setattr(standins, "in_files", None)  # deals rows out
    monkeypatch.setattr(standins, "FILE_ROWS", 40)
    for share, _ in enumerate(standins.order_facts_in_files(spark, SF, folder)):
        written.append(spark.read.parquet(folder).where(F.col("share") == share).count())
        found = spark.read.parquet(folder)
        assert found.select("share").distinct().count() == share + 1
    assert len(written) == 4 and sum(written) == found.count()
    counts = found.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert counts <= 40
    plan = found.select(*[F.count(n) for n in ("line", "header", "view")]).first()
    changes = standins.change_log(spark, SF, "order_detail", "order_info").where("type = 'insert'")
    views = standins.order_views(spark, SF).where(F.col("page")["page_id"] == "order").count()
    assert plan[0] + plan[1] == changes.count() and plan[2] == views
