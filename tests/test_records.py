"""Every text is a record or bad, as a whole."""

import pytest

from coursemill import schemas
from coursemill.operators import logsplit
from coursemill.plans import jobs
from coursemill.sources import records

LOGS = [
    ('{"common":{"mid":"m","is_new":"1"},"ts":1,"page":{"a":1,"a":2}}', logsplit.DIRTY),
    ('{"common":{"mid":"m","is_new":"1"},"ts":"1700","page":{"a":1}}', logsplit.PAGE),
    ('{"common":{"mid":"m"},"ts":1}{"x":1}', logsplit.DIRTY),
    ('{"common":{"mid":"m"},"ts":1', logsplit.DIRTY),
    ('{"common":{"mid":"m","is_new":"1"},"ts":5,"start":{}} ', logsplit.START),
    ('{"common":{"mid":"m"},"ts":"x"}', logsplit.DIRTY),
    ("x", logsplit.DIRTY), ("", logsplit.DIRTY), (None, logsplit.DIRTY), ("{}", logsplit.DIRTY),
    ("[]", logsplit.DIRTY),
]


def test_no_log_record_is_lost(spark):
    df = spark.createDataFrame([(t, i) for i, (t, _) in enumerate(LOGS)],
                               "value string, arrival long")
    got = {r.arrival: r.topic for r in jobs.split_log(df).collect()}
    assert got == {i: topic for i, (_, topic) in enumerate(LOGS)}


@pytest.mark.parametrize("text,good", [
    ('{"table":"a"}', True), ('{"table":"a"}{"table":"b"}', False), ('{"table":"a"', False),
    ('{"table":"a","data":7}', False), ("[]", False), ('{"table":5,"ts":7}', True)])
def test_a_text_is_one_record_or_bad(spark, text, good):
    df = spark.createDataFrame([(text, 1), (None, 2)], "value string, arrival long")
    assert records.records(df, schemas.CHANGE_LOG).count() == int(good)
    assert records.bad_records(df, schemas.CHANGE_LOG).count() == int(not good)


def test_times_may_be_quoted(spark):
    df = spark.createDataFrame([('{"ts":"1700"}', 1), ('{"ts":1700}', 2)],
                               "value string, arrival long")
    assert {r.ts for r in records.page_log_records(df).collect()} == {1700}


def test_config_and_order_detail_records(spark):
    df = spark.createDataFrame(
        [('{"op":"u","after":{"source_table":"s","sink_table":"d"}}', 1)],
        "value string, arrival long")
    assert records.config_records(df).first().after.sink_table == "d"
    df = spark.createDataFrame([('{"id":"1","ts":"90"}', 1)], "value string, arrival long")
    assert records.order_detail_records(df).first().row_time.second == 30
