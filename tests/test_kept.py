"""Kept tables, and the streaming jobs over them, batch by batch."""

import random

import pytest
from pyspark.sql import functions as F

from coursemill.operators import state
from coursemill.streaming import carried, sinks
from coursemill.streaming.kept import KeptTable

from .conftest import rows

VIEWS = "arrival long, mid string, is_new string, visit_date date, last_page_id string"


def views(spark, count=400, seed=1, hot=0.6):
    """Rows of some devices, one of which has most; NULL is a device too."""
    rng, out = random.Random(seed), []
    for k in range(count):
        mid = "hot" if rng.random() < hot else rng.choice(["a", "b", "c", None])
        out.append((k, mid, rng.choice("01"), f"2024-01-{1 + (k * 5 // count + rng.randrange(2)):02}",
                    rng.choice([None, "", "p", "q"])))
    return spark.createDataFrame(out, "arrival long, mid string, is_new string, d string, "
                                      "last_page_id string").withColumn(
        "visit_date", F.to_date("d")).select(*[c.split()[0] for c in VIEWS.split(", ")])


def test_a_bucket_is_one_folder_however_many_batches(spark, folder):
    table = KeptTable(spark, folder, spark.range(1).selectExpr("id", "id AS v").schema, ["id"], 4)
    assert table.read().count() == 0
    for batch in range(6):
        new = spark.range(20).select("id", (F.col("id") * 0 + batch).alias("v"))
        new = new.where("id < 10") if batch % 2 else new
        touched = table.touched(new)
        old = table.read(touched, before=batch).join(new.select("id"), "id", "left_anti")
        table.write(old.unionByName(new), batch, touched)
    assert table.folders() <= 4
    assert sorted(rows(table.read())) == [(i, 5 if i < 10 else 4) for i in range(20)]
    assert sorted(rows(table.read(before=5))) == [(i, 4) for i in range(20)]
    table.write(table.read().where("false"), 6, list(range(4)))
    assert table.folders() == 0 and table.read().count() == 0
    with pytest.raises(Exception, match="(?i)path|exist"):
        spark.read.parquet(f"{folder}/none").count()


@pytest.mark.parametrize("cuts", [[0, 400], [0, 130, 131, 300, 400]])
def test_flags_do_not_depend_on_the_batches(spark, folder, cuts):
    df = views(spark).persist()
    chunk = state.chunk_of("arrival", 32)
    flags = carried.visit_flags_writer(f"{folder}/flags", f"{folder}/last", chunk=chunk, hot_rows=20,
                                       buckets=4)
    repair = carried.repair_writer(f"{folder}/repaired", f"{folder}/first", hot_rows=20, buckets=4)
    for batch, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        part = df.where((F.col("arrival") >= low) & (F.col("arrival") < high))
        for _ in range(2):  # a replay changes nothing
            flags(part, batch)
            repair(part.drop("last_page_id"), batch)
    got = rows(spark.read.parquet(f"{folder}/flags"), "arrival", "uv_ct", "sv_ct", "so_ct")
    assert got == rows(state.visit_flags(df, chunk), "arrival", "uv_ct", "sv_ct", "so_ct")
    assert rows(spark.read.parquet(f"{folder}/repaired"), "arrival", "is_new") == rows(
        state.repair_new_visitor(df), "arrival", "is_new")


def test_first_order_flags_and_no_python_worker(spark, folder, monkeypatch):
    plans = []
    write_batch = carried.write_batch

    def seen(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().toString())
        write_batch(df, *args, **kwargs)

    monkeypatch.setattr(carried, "write_batch", seen)
    df = views(spark).select("arrival", F.col("mid").alias("user_id"),
                             F.col("visit_date").alias("order_date"))
    write = carried.first_order_writer(f"{folder}/out", f"{folder}/last", buckets=2)
    for batch in range(3):
        write(df.where(F.floor(F.col("arrival") / 150) == batch), batch)
    assert rows(spark.read.parquet(f"{folder}/out"), "arrival", "order_user_ct") == rows(
        state.daily_first_order_flag(df, state.chunk_of("arrival")), "arrival", "order_user_ct")
    assert plans and not any("Python" in p or "Pandas" in p or "Arrow" in p for p in plans)


def test_idle_devices_are_forgotten_but_not_an_open_session(spark, folder):
    clock = [0]
    write = carried.visit_flags_writer(f"{folder}/out", f"{folder}/last", idle_ms=1000, buckets=1,
                                       clock=lambda: clock[0])

    def batch(number, *data):
        write(spark.createDataFrame(data, "arrival long, mid string, d string, last_page_id string")
              .withColumn("visit_date", F.to_date("d")).drop("d"), number)

    batch(0, (1, "open", "2024-01-01", None), (2, "went", "2024-01-01", "p"))
    clock[0] = 1500
    batch(1, (3, "open", "2024-01-01", "p"), (4, "went", "2024-01-01", "p"))
    got = {r.arrival: (r.uv_ct, r.so_ct) for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {1: (1, 1), 2: (1, 0), 3: (0, -1), 4: (1, 0)}


def pairs(spark, kind, *data):
    return spark.createDataFrame(list(data), kind)


LEFT, RIGHT = "k string, a int", "_k string, b int"


def test_waiting_rows_meet_within_their_time(spark, folder):
    left, right = (spark.createDataFrame([], kind) for kind in (LEFT, RIGHT))
    join = carried.WaitingJoin(spark, folder, left.schema, right.schema, "k", "_k", 1000, 4)
    # Both orders of arrival, several rows of a key, a NULL key, and a row that comes too late.
    one = join.advance(pairs(spark, LEFT, ("x", 1), ("x", 2), (None, 3), ("late", 4)), right, 0, 0)
    assert rows(one, "k", "a", "b") == []
    two = join.advance(left, pairs(spark, RIGHT, ("x", 1), ("y", 5), (None, 6)), 1, 900)
    assert rows(two, "k", "a", "b") == [("x", 1, 1), ("x", 2, 1)]
    again = join.advance(left, pairs(spark, RIGHT, ("x", 1), ("y", 5), (None, 6)), 1, 900)
    assert rows(again, "k", "a", "b") == [("x", 1, 1), ("x", 2, 1)]  # a replay
    three = join.advance(pairs(spark, LEFT, ("y", 7)), pairs(spark, RIGHT, ("late", 8)), 2, 1500)
    assert rows(three, "k", "a", "b") == [("y", 7, 5)]
    join.expire(3, 1500)
    assert join.waiting() == (1, 3)  # the rows of the first batch have left
    join.expire(4, 9000)
    assert join.waiting() == (0, 0)


def test_rows_wait_for_their_dimension_row(spark, folder):
    clock, known = [0], [["a"]]
    write = carried.parked_lookup_writer(
        f"{folder}/out", f"{folder}/parked", f"{folder}/late",
        lambda _: spark.createDataFrame([(i, f"name {i}") for i in known[0]], "id string, n string"),
        "key", {"n": "name"}, wait_ms=60_000, clock=lambda: clock[0], buckets=4)
    schema = "key string, v int"
    none = spark.createDataFrame([], schema)

    def state_now():
        kept = carried.parked(spark, f"{folder}/parked", none.schema, "key", 4)
        late = spark.read.schema(schema).parquet(f"{folder}/late")
        return (rows(spark.read.parquet(f"{folder}/out"), "v", "name"), rows(kept, "v"),
                rows(late, "v"))

    write(spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], schema), 0)
    assert state_now() == ([(1, "name a")], [(2,), (3,)], [(4,)])
    clock[0], known[0] = 30_000, ["a", "b"]
    write(spark.createDataFrame([("c", 5)], schema), 1)
    assert state_now() == ([(1, "name a"), (2, "name b")], [(3,), (5,)], [(4,)])
    write(spark.createDataFrame([("c", 5)], schema), 1)
    assert state_now() == ([(1, "name a"), (2, "name b")], [(3,), (5,)], [(4,)])
    clock[0] = 70_000
    write(none, 2)
    assert state_now() == ([(1, "name a"), (2, "name b")], [(5,)], [(3,), (4,)])
    clock[0], known[0] = 80_000, ["a", "b", "c"]
    write(none, 3)
    found, waiting, late = state_now()
    assert found[-1] == (5, "name c") and not waiting and len(found) + len(late) == 5


def test_merged_rows_are_the_last_of_their_key(spark, folder):
    df = spark.createDataFrame([(k % 7, k, f"v{k}") for k in range(100)],
                               "id long, arrival long, v string")
    write = carried.keyed_merge_writer(folder, ["id"], df.schema, 4)
    for batch, keep in enumerate(("arrival % 3 = 0", "arrival % 3 = 2", "arrival % 3 = 1")):
        write(df.where(keep), batch)
    assert rows(carried.read_merged(spark, folder, ["id"], df.schema, 4)) == sorted(
        [(k % 7, k, f"v{k}") for k in range(93, 100)], key=repr)


def test_routing_does_not_depend_on_which_log_is_ahead(spark, folder):
    changes = spark.createDataFrame(
        [("t", "insert", {"id": str(k), "a": "x", "b": "y"}, k) for k in range(10)]
        + [("u", "insert", {"id": "1"}, 3), (None, "insert", {"id": "1"}, 4)],
        "table string, type string, data map<string,string>, arrival long")
    config = spark.createDataFrame(
        [("c", "t", "dim_t", "f", "id,a", "id", 2), ("u", "t", "dim_t", "f", "id,b", "id", 5),
         ("d", "t", "dim_t", "f", "id,b", "id", 8)],
        "op string, source_table string, sink_table string, sink_family string, "
        "sink_columns string, sink_row_key string, arrival long")
    for number, low in enumerate((5, 0)):  # the later half first
        sinks.keyed_writer(f"{folder}/changes")(
            changes.where((F.col("arrival") >= low) & (F.col("arrival") < low + 5)), number)
        sinks.keyed_writer(f"{folder}/config")(
            config.where((F.col("arrival") >= low) & (F.col("arrival") < low + 5)), number)
    for options in ({}, {"span": 2, "hot_rows": 0}):
        got = sinks.read_routed(spark, f"{folder}/changes", f"{folder}/config", **options)
        assert sorted((r.arrival, sorted(r.cols)) for r in got.collect()) == [
            *[(k, ["a", "id"]) for k in (2, 3, 4)], *[(k, ["b", "id"]) for k in (5, 6, 7)]]


def test_a_reader_sees_whole_batches_only(spark, folder):
    """A batch that breaks between its outputs shows in none of them until it has run again."""
    broken = [True]
    schema = "v long"

    def write(df, batch_id, run=""):
        sinks.write_batch(df, f"{folder}/one", batch_id, run=run)
        if batch_id == 1 and broken[0]:
            raise RuntimeError("between the outputs")
        sinks.write_batch(df, f"{folder}/two", batch_id, run=run)

    whole = sinks.marked(write, f"{folder}/marks")
    kind = spark.createDataFrame([], schema).schema

    def shown():
        return [rows(sinks.read_marked(spark, f"{folder}/{name}", f"{folder}/marks", kind))
                for name in ("one", "two")]

    assert shown() == [[], []]
    whole(spark.createDataFrame([(0,)], schema), 0, "a")
    with pytest.raises(RuntimeError):
        whole(spark.createDataFrame([(1,)], schema), 1, "a")
    assert shown() == [[(0,)], [(0,)]]
    broken[0] = False
    whole(spark.createDataFrame([(1,)], schema), 1, "a")
    assert shown() == [[(0,), (1,)], [(0,), (1,)]]


def test_folded_windows_are_reopened_by_late_parts(spark, folder):
    def part(batch, *data):
        sinks.write_batch(spark.createDataFrame(data, "cur_date string, k string, n long"),
                          f"{folder}/out", batch, ["cur_date"], "a")

    def now(**folded):
        return rows(sinks.read_windows(spark, f"{folder}/out", ["n"], **folded), "cur_date", "k", "n")

    part(0, ("20240101", "x", 1), ("20240102", "x", 5))
    part(1, ("20240101", "x", 2), ("20240101", "y", 7))
    assert sinks.fold_windows(spark, f"{folder}/out", ["n"], f"{folder}/folded") == 1
    part(2, ("20240101", "x", 10))
    want = [("20240101", "x", 13), ("20240101", "y", 7), ("20240102", "x", 5)]
    assert now() == now(folded=f"{folder}/folded") == want
    assert sinks.fold_windows(spark, f"{folder}/out", ["n"], f"{folder}/folded") == 2
    assert now(folded=f"{folder}/folded") == want
    # A day is one row per window, however many parts it came in.
    assert spark.read.parquet(f"{folder}/folded/rows/number=2").count() == 3


def test_late_rows_are_an_output(spark, folder):
    write = sinks.windows_and_late_writer(
        f"{folder}/out", f"{folder}/late", f"{folder}/marks", "t",
        lambda df: df.groupBy((F.floor(F.unix_seconds("t") / 10) * 10).alias("start")).agg(
            F.count("*").alias("n")).withColumn("cur_date", F.lit("20240101")))

    def batch(number, *seconds):
        write(spark.createDataFrame([(k,) for k in seconds], "s long").select(
            F.timestamp_seconds("s").alias("t")), number)

    for _ in range(2):  # a replay changes nothing
        batch(0, 5, 21, None)
    batch(1, 9, 12, 31)  # the watermark is 19: only the window up to 10 has ended
    batch(2, 19, 28, 60)
    assert sinks.watermark_seconds(spark, f"{folder}/marks") == 58
    got = sinks.read_windows(spark, f"{folder}/out", ["n"])
    assert rows(got, "start", "n") == [(0, 1), (10, 1), (20, 2), (30, 1), (60, 1)]
    late = spark.read.parquet(f"{folder}/late").select(F.unix_seconds("t").alias("s"))
    assert sorted(r.s for r in late.collect() if r.s is not None) == [9, 19] and late.count() == 3
