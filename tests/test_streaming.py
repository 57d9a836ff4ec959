"""Streams over several micro-batches give what the batch jobs give on the same rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from coursemill.operators import facts, logsplit, reports, state, windows
from coursemill.operators.joins import interval_join
from coursemill.plans import jobs
from coursemill.plans import standins as s
from coursemill.sources import records, tables, topics
from coursemill.schemas import PAGE_LOG
from coursemill.streaming import jobs as streams
from coursemill.streaming import sinks
from coursemill.streaming import state as keyed
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def as_stream(spark, df, path, by="arrival", files=3):
    """The rows as files that are read one per micro-batch, in order."""
    bounds = [i / files for i in range(1, files)]
    cuts = df.approxQuantile(by, bounds, 0.0) if bounds else []
    place = sum(((F.col(by) > c).cast("int") for c in cuts), F.lit(0))
    for number in range(files):
        df.where(place == number).coalesce(1).write.mode("append").parquet(path)
    return topics.read_folder(spark, path, df.schema, files_per_trigger=1)


def run(stream, write, folder):
    query = sinks.start(stream, write, f"{folder}/checkpoint", every=None)
    query.awaitTermination()
    return query


def collected(spark, stream, folder):
    query = run(stream, sinks.keyed_writer(f"{folder}/out"), folder)
    return query, spark.read.parquet(f"{folder}/out").drop(*sinks.PLACE)


def closed(df, last, disorder):
    return df.where(F.to_timestamp("edt") <= F.lit(last - dt.timedelta(seconds=disorder)))


def test_traffic_windows(spark, folder):
    views = s.page_views(spark, SF)
    source = s.base_source(spark, SF)
    stream = streams.traffic_windows(as_stream(spark, views, f"{folder}/in"), idle_ms=None)
    known = source.where("id <> '3'")
    write = sinks.report_writer(
        f"{folder}/out", [(lambda: known, "sc", {"source_site": "source_name"})],
        f"{folder}/missing")
    query = run(stream, write, folder)
    assert len(query.recentProgress) >= 3
    assert sinks.dropped_late_rows(query) == 0
    batch = jobs.traffic_windows(views, known, state.chunk_of("arrival"))
    last = views.agg(F.max("row_time")).first()[0]
    out = spark.read.parquet(f"{folder}/out").withColumn("cur_date", F.col("cur_date").cast("string"))
    columns = sorted(batch.columns)
    assert rows(out, *columns) == rows(closed(batch, last, 2), *columns)
    missing = spark.read.parquet(f"{folder}/missing/0-sc")
    assert missing.count() > 0 and {r.sc for r in missing.collect()} == {"3"}


def test_visit_flags_and_repair(spark, folder):
    views = s.page_views(spark, SF).select(
        "arrival", "mid", "is_new", "last_page_id", "visit_date")
    chunk = state.chunk_of("arrival")
    stream = as_stream(spark, views, f"{folder}/in")
    _, flags = collected(spark, keyed.visit_flags(stream, idle_ms=None), f"{folder}/flags")
    assert rows(flags, *flags.columns) == rows(state.visit_flags(views, chunk), *flags.columns)
    _, fixed = collected(spark, keyed.repair_new_visitor(stream), f"{folder}/fixed")
    assert rows(fixed, *fixed.columns) == rows(
        state.repair_new_visitor(views), *fixed.columns)


def test_log_split(spark, folder):
    log = s.behaviour_log(spark, SF)
    stream = as_stream(spark, log, f"{folder}/in", files=2)
    run(streams.split_log(stream), sinks.topics_writer(f"{folder}/out"), folder)
    out = spark.read.parquet(f"{folder}/out")
    batch = jobs.split_log(log)
    names = ("topic", "arrival", "value")
    assert rows(out, *names) == rows(batch, *names)


def test_keyword_windows_from_topic(spark, folder):
    log = s.page_log(spark, SF)
    text = topics.to_messages(log.select("common", "page", "ts", "arrival"), "page").join(
        log.select("arrival", F.get_json_object(F.to_json(F.struct("ts")), "$.ts").alias("t")),
        F.get_json_object("value", "$.arrival") == F.col("arrival")).select("value", "arrival")
    stream = records.page_log_records(as_stream(spark, text, f"{folder}/in"))
    _, out = collected(spark, streams.keyword_windows(stream), folder)
    batch = jobs.keyword_windows(records.page_log_records(text))
    last = log.where(F.col("page")["item_type"] == "keyword").agg(
        F.max(F.date_trunc("second", "row_time"))).first()[0]
    assert rows(out, *batch.columns) == rows(closed(batch, last, 0), *batch.columns)
    assert records.records(text, PAGE_LOG).count() == log.count()


@pytest.mark.parametrize("job", ["trade", "course"])
def test_trade_and_course_windows(spark, folder, job):
    details = facts.order_detail(
        s.change_log(spark, SF, "order_detail", "order_info"), s.order_views(spark, SF))
    # Rows arrive in time order, and within an instant as the table orders them.
    order = ("ts_number", *s.ARRIVAL)
    flat = details.withColumn("ts_number", F.col("ts").cast("bigint")).select(
        *details.columns, "ts_number", "arrival.*").drop("arrival")
    stream = as_stream(spark, flat, f"{folder}/in", by="ts_number", files=2)
    ordered = flat.withColumn("arrival", F.struct(*order))
    if job == "trade":
        out = streams.trade_windows(stream, order, idle_ms=None)
        batch = windows.trade_by_source_and_province(jobs.trade_flags(ordered, F.lit(0)))
    else:
        out = streams.course_windows(stream, order, idle_ms=None)
        batch = windows.trade_by_course(jobs.trade_flags(ordered, F.lit(0), jobs.COURSE_COLUMNS))
    _, got = collected(spark, out, folder)
    last = flat.agg(F.max(F.timestamp_seconds("ts_number"))).first()[0]
    columns = sorted(batch.columns)
    assert rows(got, *columns) == rows(closed(batch, last, 2), *columns)


def test_interval_join(spark, folder):
    events = s.table(spark, SF, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("t"))
    bought = events.where("event_type = 'purchase'").select(
        "user_id", F.col("event_id").alias("purchase"), F.col("t").alias("bought_at"))
    seen = events.where("event_type = 'view'").select(
        "user_id", F.col("event_id").alias("view"), F.col("t").alias("seen_at"))
    one_day = (["user_id"], "bought_at", "seen_at", 24 * 3600, 3600)
    expected = rows(interval_join(bought, seen, *one_day), "purchase", "view")
    assert len(expected) > 20
    # One file each: with zero disorder, two batches read in step would drop what is late.
    left = as_stream(spark, bought, f"{folder}/left", "purchase", 1)
    right = as_stream(spark, seen, f"{folder}/right", "view", 1)
    joined = interval_join(left.withWatermark("bought_at", "0 seconds"),
                           right.withWatermark("seen_at", "0 seconds"), *one_day)
    _, out = collected(spark, joined, folder)
    assert rows(out, "purchase", "view") == expected


def change(table, i, seconds, **data):
    return ("edu", table, "insert", str(seconds), data, None, i)


CHANGE_COLUMNS = ("database string, `table` string, type string, ts string, "
                  "data map<string,string>, old map<string,string>, arrival bigint")


def test_order_detail_and_payment(spark, folder):
    t = 1_700_000_000
    changes = spark.createDataFrame([
        change("order_info", 0, t, id="o1", session_id="s1", province_id="7"),
        change("order_detail", 1, t + 1, id="d1", order_id="o1", user_id="u", course_id="c",
               final_amount="5.00", create_time="2023-11-14 22:13:21"),
        change("order_detail", 2, t + 2, id="d2", order_id="o1", user_id="u", course_id="c",
               final_amount="6.00", create_time="2023-11-14 22:13:22"),
        change("order_detail", 3, t + 60, id="d3", order_id="o1"),
        change("payment_info", 4, t + 901, id="p1", order_id="o1", total_amount="11",
               payment_status="1602"),
        change("payment_info", 5, t + 2, id="p2", order_id="o1", total_amount="11",
               payment_status="1601"),
    ], CHANGE_COLUMNS).withColumn("row_time", F.timestamp_seconds(F.col("ts").cast("bigint")))
    page_log = spark.createDataFrame(
        [({"sc": sc, "sid": "s1"}, {"page_id": page}, i, (t + at) * 1000)
         for i, (sc, page, at) in enumerate([("1", "order", -1), ("2", "order", 0),
                                             ("3", "home", 0)])],
        "common map<string,string>, page map<string,string>, arrival bigint, ts bigint"
    ).withColumn("row_time", F.timestamp_millis("ts"))

    # Batch: every line of the order joins; the last view of the session wins, or all do.
    assert rows(facts.order_detail(changes, page_log), "id", "source", "province_id", "date_id")[
        :2] == [("d1", "2", "7", "2023-11-14"), ("d2", "2", "7", "2023-11-14")]
    assert facts.order_detail(changes, page_log, "all").count() == 6

    # Stream: only rows within the band of each other.
    details = streams.order_detail(as_stream(spark, changes, f"{folder}/changes", files=1),
                                   as_stream(spark, page_log, f"{folder}/log", files=1))
    run(details, sinks.keyed_writer(f"{folder}/details"), f"{folder}/d")
    out = spark.read.parquet(f"{folder}/details")
    assert rows(out, "id", "source") == [
        ("d1", "1"), ("d1", "2"), ("d2", "1"), ("d2", "2")]
    assert rows(sinks.read_keyed(spark, f"{folder}/details", "id"), "id") == [("d1",), ("d2",)]

    # The payment comes exactly 15 minutes after d1: the end of the interval counts.
    paid = facts.payment_success(changes, out.where("source = '2'").drop(*sinks.PLACE))
    assert rows(paid, "id", "detail_id", "ts") == [
        ("p1", "d1", str(t + 1)), ("p1", "d2", str(t + 2))]
    stream = streams.payment_success(
        as_stream(spark, changes, f"{folder}/c2", files=1),
        as_stream(spark, out.where("source = '2'").drop(*sinks.PLACE), f"{folder}/d2", files=1))
    _, got = collected(spark, stream, f"{folder}/paid")
    assert rows(got, "id", "detail_id") == [("p1", "d1"), ("p1", "d2")]


def test_replayed_batch_changes_nothing(spark, folder):
    df = spark.createDataFrame([("2024-01-01", "1", 5), ("2024-01-02", "2", 6)],
                               "cur_date string, sc string, n int")
    names = spark.createDataFrame([("1", "one"), ("2", "two")], "id string, name string")
    write = sinks.report_writer(f"{folder}/r", [(lambda: names, "sc", {"name": "source_name"})])
    for batch_id in (0, 1, 1, 0):
        write(df, batch_id)
    out = spark.read.parquet(f"{folder}/r")
    assert out.groupBy("source_name").agg(F.sum("n").alias("n")).count() == 2
    assert out.agg(F.sum("n")).first()[0] == 22
    day = tables.report_day_partition(
        spark, f"{folder}/r", 20240101, "run=*/batch_id=*")
    assert day.agg(F.sum("n")).first()[0] == 10
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cast(cur_date" in plan


def test_fact_stream_sees_the_current_dimension(spark, folder):
    reviews = spark.createDataFrame(
        [change("review_info", i, i, id=str(i), user_id="u", course_id="c", review_stars="5")
         for i in (1, 2)], CHANGE_COLUMNS)
    dim = f"{folder}/course"

    def name(value, batch):
        spark.createDataFrame([("c", value)], "id string, course_name string").write.parquet(
            f"{dim}/{batch}")

    def current():
        return (spark.read.parquet(f"{dim}/*").groupBy("id")
                .agg(F.max("course_name").alias("course_name")))

    write = sinks.job_writer(f"{folder}/review", lambda df: facts.review(df, current()))

    def named_then_write(df, batch_id, run=""):
        name(f"name {batch_id}", batch_id)
        write(df, batch_id)

    run(as_stream(spark, reviews, f"{folder}/in", files=2), named_then_write, folder)
    assert rows(sinks.read_keyed(spark, f"{folder}/review", "id"), "id", "course_name") == [
        ("1", "name 0"), ("2", "name 1")]


def test_dimension_stream(spark, folder):
    changes = spark.createDataFrame(
        [change("course", 0, 0, id="1", name="a"), change("course", 1, 1, id="1", price="3"),
         change("other", 2, 2, id="9"), change("course", 3, 3, name="no key")], CHANGE_COLUMNS)
    config = spark.createDataFrame(
        [("course", "dim_course", "info", "id,name,price", "id")],
        "source_table string, sink_table string, sink_family string, sink_columns string, "
        "sink_row_key string")
    write = sinks.dimension_writer(f"{folder}/log", lambda: config, f"{folder}/quarantine")
    run(as_stream(spark, changes, f"{folder}/in", files=2), write, folder)
    assert rows(sinks.read_dimensions(spark, f"{folder}/log")) == [
        ("dim_course", "1", {"id": "1", "name": "a", "price": "3"})]
    assert spark.read.parquet(f"{folder}/quarantine").count() == 1


def test_no_rows_on_a_day(spark):
    empty = spark.createDataFrame([], "source_name string, so_ct bigint, sv_ct bigint, cur_date string")
    assert rows(reports.bounce_rate_by_source(reports.one_day(empty))) == []


def test_no_sessions_is_a_rate_of_zero(spark):
    df = spark.createDataFrame([("a", 0, 0), ("b", 1, 3)],
                               "source_name string, so_ct bigint, sv_ct bigint")
    assert [(r[0], str(r[1])) for r in rows(reports.bounce_rate_by_source(df))] == [
        ("a", "0.00"), ("b", "0.33")]


def test_ties_at_the_edge_go_by_name(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "source_name string, order_ct bigint")
    assert rows(reports.orders_by_source(df, 2)) == [("a", 1), ("c", 2)]


def test_messages_leave_out_nulls(spark):
    df = spark.createDataFrame([("a", None, 1)], "source_name string, sc string, ts bigint")
    assert rows(topics.to_messages(df, "t", "ts")) == [("t", '{"source_name":"a"}')]


def test_bad_messages(spark):
    topic = spark.createDataFrame(
        [('{"table":"a"}', 0), ("{bad", 1), (None, 2)], "value string, arrival bigint")
    assert records.change_log_records(topic).count() == 1
    from coursemill.schemas import CHANGE_LOG
    assert rows(records.bad_records(topic, CHANGE_LOG)) == [("{bad", 1)]


def test_kafka_options():
    options = topics.kafka_read_options("host:9092", "topic_db")
    assert options["startingOffsets"] == "latest"
    assert options["kafka.isolation.level"] == "read_committed"


def test_page_views_from_topic(spark):
    text = '{"common":{"mid":"m","is_new":"1","sc":"2"},"page":{"during_time":7},"ts":1500}'
    topic = spark.createDataFrame([(text, 0)], "value string, arrival bigint")
    row = logsplit.page_views(topic).first()
    assert (row.mid, row.sc, row.during_time, row.row_time.microsecond) == ("m", "2", 7, 500000)
