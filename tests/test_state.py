import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from coursemill.operators import state
from tests.conftest import rows

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
CHUNKS = [1, 2, 3, 1000]


def frame(spark, data, schema):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "arrival bigint, " + schema)


@pytest.mark.parametrize("span", CHUNKS)
@pytest.mark.parametrize("sent, expected", [
    ([(D1, "1"), (D1, "1"), (D2, "1")], ["1", "1", "0"]),
    ([(D1, "0"), (D1, "1")], ["0", "0"]),
])
def test_repair(spark, span, sent, expected):
    df = frame(spark, [("m", *s) for s in sent], "mid string, visit_date date, is_new string")
    fixed = state.repair_new_visitor(df, hot_rows=span - 1)
    assert [r[1] for r in rows(fixed, "arrival", "is_new")] == expected


@pytest.mark.parametrize("span", CHUNKS)
def test_daily_unique_with_late_row(spark, span):
    df = frame(spark, [("m", d, "p") for d in (D1, D1, D2, D1)],
               "mid string, visit_date date, last_page_id string")
    flagged = state.visit_flags(df, state.chunk_of("arrival", span), hot_rows=0)
    assert [r[1] for r in rows(flagged, "arrival", "uv_ct")] == [1, 0, 1, 1]


@pytest.mark.parametrize("span", CHUNKS)
def test_bounce(spark, span):
    df = frame(spark, [("m", D1, p) for p in (None, "p", "p", None, "", "p")],
               "mid string, visit_date date, last_page_id string")
    flagged = state.visit_flags(df, state.chunk_of("arrival", span), hot_rows=0)
    assert [r[1:] for r in rows(flagged, "arrival", "so_ct", "sv_ct")] == [
        (1, 1), (-1, 0), (0, 0), (1, 1), (1, 1), (-1, 0)]


@pytest.mark.parametrize("span", CHUNKS)
def test_first_order_of_day(spark, span):
    df = frame(spark, [("u", d) for d in (D1, D1, D2)], "user_id string, order_date date")
    flagged = state.daily_first_order_flag(df, state.chunk_of("arrival", span), hot_rows=0)
    assert [r[1] for r in rows(flagged, "arrival", "order_user_ct")] == [1, 0, 1]


def replay(data):
    """The rules row by row: (mid, day, is_new, last_page_id) to (is_new, uv, sv, so)."""
    first, last, open_ = {}, {}, {}
    out = []
    for mid, day, is_new, page in data:
        if mid not in first:
            first[mid] = day if is_new == "1" else day - dt.timedelta(days=1)
        fixed = "0" if is_new == "1" and first[mid] != day else is_new
        uv = int(last.get(mid) != day)
        last[mid] = day
        starts = not page
        so = 1 if starts else -1 if open_.get(mid) else 0
        open_[mid] = starts
        out.append((fixed, uv, int(starts), so))
    return out


@pytest.mark.parametrize("span, hot_rows", [(1, 0), (7, 0), (64, 100), (64, 10_000)])
def test_random_rows_with_a_hot_device(spark, span, hot_rows):
    rnd = random.Random(5)
    data = [(rnd.choice(["hot"] * 4 + list("abcdefgh")),
             D1 + dt.timedelta(days=i // 80 - rnd.choice([0, 0, 0, 1])),
             rnd.choice("01"), rnd.choice([None, "", "p", "q"])) for i in range(600)]
    df = frame(spark, data, "mid string, visit_date date, is_new string, last_page_id string")
    chunk = state.chunk_of("arrival", span)
    flagged = state.visit_flags(state.repair_new_visitor(df, hot_rows=hot_rows), chunk,
                                hot_rows=hot_rows)
    got = [r[1:] for r in sorted(tuple(r) for r in flagged.select(
        "arrival", "is_new", "uv_ct", "sv_ct", "so_ct").collect())]
    assert got == replay(data)


def test_work_is_split_by_chunk(spark):
    """The sort of the rows is by (key, chunk), so a hot key is spread over tasks."""
    df = spark.range(10).select(F.col("id").alias("arrival"), F.lit("hot").alias("mid"),
                                F.lit(D1).alias("visit_date"), F.lit("p").alias("last_page_id"))
    plan = state.visit_flags(df, state.chunk_of("arrival", 2))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    flags = physical[:physical.index("Union")]
    assert "hashpartitioning(mid" in flags and "_chunk" in flags.split("hashpartitioning(")[1]


def test_null_is_a_key_like_any_other(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    data = [(None, days[0], "1", 1, None), (None, days[1], "1", 2, "p"), (None, days[1], "1", 3, "p"),
            ("m", days[1], "1", 4, None), ("m", days[2], "1", 5, None), ("k", days[2], "0", 6, "q")]
    df = spark.createDataFrame(
        data, "mid string, visit_date date, is_new string, arrival long, last_page_id string")
    for hot_rows in (0, 2, 1_000_000):
        fixed = state.repair_new_visitor(df, hot_rows=hot_rows)
        assert {r.arrival: r.is_new for r in fixed.collect()} == {
            1: "1", 2: "0", 3: "0", 4: "1", 5: "0", 6: "0"}
        flags = state.visit_flags(df, state.chunk_of("arrival", 2), hot_rows=hot_rows)
        assert {r.arrival: (r.uv_ct, r.sv_ct, r.so_ct) for r in flags.collect()} == {
            1: (1, 1, 1), 2: (1, 0, -1), 3: (0, 0, 0), 4: (1, 1, 1), 5: (1, 1, 1), 6: (1, 0, 0)}
    assert state.hot_keys(df, "mid", 0).where(F.col("mid").isNull()).count() == 1


def test_no_hot_key_is_left_out_where_they_are_more_than_are_broadcast(spark, monkeypatch):
    from coursemill.operators import joins

    monkeypatch.setattr(joins, "HOT_KEYS", 3)
    rnd = random.Random(8)
    data = [(f"m{i % 12}", D1 + dt.timedelta(days=i // 80), rnd.choice("01"),
             rnd.choice([None, "", "p", "q"])) for i in range(480)]  # 40 rows each
    df = frame(spark, data, "mid string, visit_date date, is_new string, last_page_id string")
    assert joins.hot_keys(df, "mid", 0).count() == 12
    assert joins.hot_keys(df, "mid", 39).count() == 12
    flagged = state.visit_flags(state.repair_new_visitor(df, hot_rows=0),
                                state.chunk_of("arrival", 7), hot_rows=0)
    got = [r[1:] for r in sorted(tuple(r) for r in flagged.select(
        "arrival", "is_new", "uv_ct", "sv_ct", "so_ct").collect())]
    assert got == replay(data)
