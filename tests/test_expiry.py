"""Keyed state under a processing-time limit: it expires, but for a session start."""

import datetime as dt
import time

from coursemill.sources import topics
from coursemill.streaming import sinks
from coursemill.streaming import state as keyed

SCHEMA = "mid string, last_page_id string, visit_date date, arrival long"
DAY = dt.date(2024, 1, 1)


def read_until(spark, path, count, seconds=90):
    end = time.time() + seconds
    while time.time() < end:
        try:
            rows = spark.read.parquet(path).collect()
        except Exception:  # not written yet
            rows = []
        if len(rows) >= count:
            return {r.arrival: (r.uv_ct, r.sv_ct, r.so_ct) for r in rows}
        time.sleep(1)
    raise AssertionError("the stream gave too few rows")


def test_idle_state_expires_and_session_starts_outlive_it(spark, folder):
    def put(*rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{folder}/in")

    def run():
        stream = topics.read_folder(spark, f"{folder}/in", spark.createDataFrame(
            [], SCHEMA).schema)
        return sinks.start(keyed.visit_flags(stream, idle_ms=3000),
                           sinks.keyed_writer(f"{folder}/out"), f"{folder}/c", every="1 second")

    put(("idle", "p", DAY, 1), ("starts", None, DAY, 2))
    query = run()
    try:
        first = read_until(spark, f"{folder}/out", 2)
        assert first == {1: (1, 0, 0), 2: (1, 1, 1)}
        time.sleep(12)  # several batches without rows
    finally:
        query.stop()
    put(("idle", "p", DAY, 3), ("starts", "q", DAY, 4))
    query = run()  # goes on from the checkpoint
    try:
        got = read_until(spark, f"{folder}/out", 4)
    finally:
        query.stop()
    assert got[3] == (1, 0, 0)  # forgotten, so counted again
    assert got[4] == (0, 0, -1)  # the session went on
