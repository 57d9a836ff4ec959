"""Batches that are written again, runs that are resumed, input cut in other ways."""

import pytest
from pyspark.sql import functions as F

from coursemill.operators import windows
from coursemill.plans import standins as s
from coursemill.streaming import jobs as streams
from coursemill.streaming import sinks
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def test_a_replay_replaces_all_of_its_batch(spark, folder):
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "cur_date string, n int")
    read = lambda: {r.n for r in spark.read.parquet(folder).collect()}
    sinks.write_batch(df, folder, 0, ["cur_date"], "a")
    sinks.write_batch(df.where("n = 1"), folder, 0, ["cur_date"], "b")  # another run's batch 0
    assert spark.read.parquet(folder).count() == 3
    sinks.write_batch(df.where("n = 2"), folder, 0, ["cur_date"], "a")
    assert spark.read.parquet(folder).where("run = 'a'").count() == 1 and read() == {1, 2}
    sinks.write_batch(df.where("false"), folder, 0, ["cur_date"], "a")
    assert read() == {1}


def test_quarantined_rows_leave_when_they_match_on_replay(spark, folder):
    row = spark.createDataFrame([("2024-01-01", "1", 5)], "cur_date string, sc string, n int")
    known = [spark.createDataFrame([("9", "x")], "id string, name string"),
             spark.createDataFrame([("1", "x")], "id string, name string")]
    now = []
    write = sinks.report_writer(f"{folder}/r", [(lambda: now[-1], "sc", {"name": "name"})],
                                f"{folder}/q")
    for dim in known:
        now.append(dim)
        write(row, 0, "a")
    assert spark.read.parquet(f"{folder}/r").count() == 1
    assert spark.read.parquet(f"{folder}/q/0-sc").count() == 0


@pytest.mark.parametrize("files", [1, 3, 6])
def test_windows_do_not_depend_on_how_the_input_is_cut(spark, folder, files):
    """Rows come in any order of time; the query is stopped and resumed half way."""
    log = s.page_log(spark, SF).withColumn(
        "row_time", F.timestamp_millis(F.col("ts"))).withColumn("n", F.xxhash64("arrival"))
    stream = s.in_files(log, "n", f"{folder}/in", files)
    write = sinks.window_parts_writer(f"{folder}/out", windows.keyword_counts)
    query = sinks.start(windows.searches(stream), write, f"{folder}/c", every=None)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == files
    s.in_files(log, "n", f"{folder}/in", files)  # as many rows again
    sinks.start(windows.searches(stream), write, f"{folder}/c", every=None).awaitTermination()
    got = sinks.read_windows(spark, f"{folder}/out", ["keyword_count"])
    want = windows.keyword_counts(windows.searches(log)).withColumn(
        "keyword_count", F.col("keyword_count") * 2)
    assert rows(got, *want.columns) == rows(want)


def test_rows_behind_the_watermark_are_counted(spark, folder):
    """The watermark jobs drop what is late, and say how many rows; the parts keep them."""
    log = s.page_log(spark, SF).withColumn(
        "row_time", F.timestamp_millis(F.col("ts"))).withColumn("n", -F.col("ts"))
    stream = s.in_files(log, "n", f"{folder}/in", 4)  # latest first
    query = sinks.start(streams.keyword_windows(stream), sinks.keyed_writer(f"{folder}/out"),
                        f"{folder}/c", every=None)
    query.awaitTermination()
    assert sinks.dropped_late_rows(query) > 0


def test_chapter_windows(spark, folder):
    plays = spark.createDataFrame(
        [("c", 1, 30, 1, 100), ("c", 1, 20, 0, 103), ("d", 1, 5, 1, 112), ("d", 1, 1, 1, None)],
        "chapter_id string, play_count long, play_sec long, play_user long, t long").withColumn(
        "row_time", F.timestamp_seconds("t"))
    want = {("c", 2, 50, 1), ("d", 1, 5, 1)}
    got = windows.plays_by_chapter(plays.where("row_time IS NOT NULL"))
    assert {(r.chapter_id, r.play_count, r.play_sec, r.play_user) for r in got.collect()} == want
    plays.where("chapter_id = 'c'").coalesce(1).write.parquet(f"{folder}/in")
    plays.where("chapter_id = 'd'").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(plays.schema).parquet(f"{folder}/in")
    query = sinks.start(streams.chapter_windows(stream), sinks.keyed_writer(f"{folder}/out"),
                        f"{folder}/c", every=None)
    query.awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    assert {(r.chapter_id, r.play_count, r.play_sec, r.play_user) for r in out.collect()} <= want


def test_a_day_is_read_alone(spark, folder):
    from coursemill.sources import tables

    df = spark.createDataFrame([(f"2024-01-{d:02d}", d) for d in range(1, 20)], "cur_date string, n int")
    sinks.write_batch(df, folder, 0, ["cur_date"], "a")
    sinks.write_batch(df.where("n = 3"), folder, 1, ["cur_date"], "a")
    day = tables.report_day_partition(spark, folder, 20240103, "run=*/batch_id=*")
    assert [r.n for r in day.collect()] == [3, 3] and len(day.inputFiles()) == 2
    assert tables.report_day_partition(spark, folder, 20230103, "run=*/batch_id=*").count() == 0
