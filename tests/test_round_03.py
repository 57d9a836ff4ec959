"""What the review of the third round found."""

import duckdb
import pytest
from pyspark.sql import functions as F

from check import canonical
from coursemill.operators import asof, dims
from coursemill.plans import catalog, jobs, standins
from coursemill.streaming import carried, kept, sinks, state

from .conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [
    "stream_trade_windows_in_batches", "stream_traffic_windows_in_batches", "stream_trade_windows",
    "stream_traffic_windows"])
def test_window_streams_keep_no_python_state(spark, monkeypatch, name):
    def refused(*_):
        raise AssertionError("a Python function per key")

    monkeypatch.setattr(state, "_keyed", refused)
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_a_snapshot_of_many_days_is_no_folder_per_day(spark, folder):
    days = spark.range(3000).select(F.date_add(F.lit("2000-01-01"), F.col("id").cast("int")).cast(
        "string").alias("cur_date"), F.col("id").alias("n"))
    sinks.write_batch(days, f"{folder}/out", 0, run="a")
    sinks.fold_windows(spark, f"{folder}/out", ["n"], f"{folder}/folded")
    assert len(spark.read.parquet(f"{folder}/folded/rows").inputFiles()) < 100
    assert rows(sinks.read_windows(spark, f"{folder}/out", ["n"], f"{folder}/folded"),
                "cur_date", "n") == rows(days)


def test_micro_batches_of_late_rows_are_those_of_the_sql(spark, folder):
    """Shares of the events that are far from a quarter each."""
    spark.read.parquet(f"{SF}/events.parquet").where(
        "event_id % 4 = 0 OR event_id % 20 IN (1, 2, 3)").coalesce(1).write.parquet(
        f"{folder}/events.parquet")
    name = "stream_keyword_windows_and_late_rows"
    got = catalog.QUERIES[name](spark, folder)
    columns = sorted(got.columns)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    expected = db.sql(f"SELECT {', '.join(columns)} FROM ({catalog.ORACLE[name]})").fetchall()
    assert canonical(got.select(*columns).collect()) == canonical(expected)


def test_log_records_are_dealt_to_tasks_by_their_number(spark, folder, monkeypatch):
    want = canonical(catalog.QUERIES["log_split"](spark, SF).collect())
    monkeypatch.setattr(standins, "LOG_ROWS", 20)  # 1,000 events
    log = standins.behaviour_log(spark, SF)
    assert log.rdd.getNumPartitions() >= 50
    tasks = standins.log_tasks(spark, SF)
    split = catalog.QUERIES["log_split"](spark, SF)
    assert "REPARTITION_BY_NUM, [plan_id" in split._jdf.queryExecution().toString() and tasks >= 50
    assert canonical(split.collect()) == want


def test_waiting_rows_are_written_once(spark, folder, monkeypatch):
    monkeypatch.setattr(kept, "FOLD", 3)
    left, right = (spark.createDataFrame([], kind) for kind in ("k long, a long", "_k long, b long"))
    join = carried.WaitingJoin(spark, folder, left.schema, right.schema, "k", "_k", 1000, 2)
    found, written = [], []
    for batch in range(7):
        lines = spark.range(batch * 10, batch * 10 + 10).select("id", "id").toDF("k", "a")
        heads = spark.range(60 - batch * 10, 70 - batch * 10).select("id", "id").toDF("_k", "b")
        for _ in range(2):  # a replay changes nothing
            met = rows(join.advance(lines, heads, batch, batch), "a", "b")
        found += met
        written.append(spark.read.parquet(f"{folder}/left/rows/batch={batch}").count())
        assert join.tables[0].folders() <= 2 * 3
    assert sorted(found) == [(k, k) for k in range(70)]
    assert written[:3] == [10, 10, 10] and join.waiting() == (70, 70)


@pytest.mark.parametrize("name,columns", [
    ("trade_windows", jobs.TRADE_COLUMNS), ("course_windows", jobs.COURSE_COLUMNS)])
def test_window_jobs_join_and_store_what_they_read(spark, monkeypatch, name, columns):
    seen = []
    store = catalog.stored
    monkeypatch.setattr(catalog, "stored", lambda df, as_: store(seen.append(df) or df, as_))
    catalog.QUERIES[name](spark, SF).count()
    assert sorted(seen[0].columns) == sorted(
        {"sc": "source", "row_time": "ts"}.get(c, c) for c in columns)


def test_one_version_per_chunk_of_a_hot_key_comes_together(spark, monkeypatch):
    """The window over a key's whole history has a row per chunk, and columns that nobody reads are
    not shuffled."""
    versions = spark.range(1000).select(
        F.lit("k").alias("of"), F.col("id").alias("arrival"), F.col("id").cast("string").alias("v"))
    asked = spark.range(0, 1000, 7).select(
        F.lit("k").alias("key"), F.col("id").alias("arrival"), F.col("id").alias("unread"))
    found = asof.as_of(asked, versions, "key", "of", ["v"], span=100, hot_rows=0).select(
        "arrival", "version.v")
    assert sorted(rows(found)) == [(n, str(n)) for n in range(0, 1000, 7)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by(_held" in plan and "unread" not in plan


def test_a_batch_of_a_merged_table_writes_its_own_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(kept, "FOLD", 3)
    kind = "id long, v long, arrival long"
    schema = spark.createDataFrame([], kind).schema
    write, written, last = carried.keyed_merge_writer(folder, ["id"], schema, 1), [], {}
    for batch in range(7):
        new = [(k, batch, batch * 100 + k) for k in range(batch, batch + 10)]
        for _ in range(2):  # a replay changes nothing
            write(spark.createDataFrame(new, kind), batch)
        last |= {r[0]: r for r in new}
        written.append(spark.read.parquet(f"{folder}/rows/batch={batch}").count())
        assert sorted(rows(carried.read_merged(spark, folder, ["id"], schema, 1))) == sorted(
            last.values())
    assert written == [10, 10, 10, 13, 10, 10, 16]


def test_compacting_runs_its_input_once(spark):
    kind = "sink_table string, row_key string, op string, cols map<string,string>, arrival long"
    routed = spark.createDataFrame([
        ("d", "1", "insert", {"a": "x", "b": "y"}, 1), ("d", "1", "delete", None, 2),
        ("d", "1", "update", {"a": "z", "b": None}, 3), ("d", "2", "insert", {"a": "q"}, 4)], kind)
    found = dims.compacted(routed)
    assert sorted(rows(found)) == [
        ("d", "1", "delete", None, 2), ("d", "1", "update", {"a": "z"}, 3),
        ("d", "2", "update", {"a": "q"}, 4)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("max_by") <= 2


def test_flags_and_repair_read_a_micro_batch_once(spark, monkeypatch):
    started, start = [], sinks.start
    monkeypatch.setattr(sinks, "start", lambda *a, **k: started.append(a) or start(*a, **k))
    assert catalog.QUERIES["stream_visit_flags_and_repair"](spark, SF).count() == 1000
    assert len(started) == 1


def test_writers_together_share_a_computed_batch(spark):
    kept_in_memory = []

    def writer(df, batch_id, run=""):
        kept_in_memory.append(df.storageLevel.useMemory)

    df = spark.range(3)
    carried.together(carried.once_computed(writer), carried.once_computed(writer))(df, 0)
    assert kept_in_memory == [True, True] and not df.storageLevel.useMemory
