import pytest
from pyspark.sql import functions as F

from coursemill.operators.enrich import enrich, enrich_or_mark, without_dimension
from coursemill.operators.joins import interval_join, spread_join
from coursemill.operators.upsert import latest_per_key
from tests.conftest import rows

T0 = 1_700_000_000_000  # milliseconds


def at(df, name):
    return df.withColumn(name, F.timestamp_millis(F.col(name)))


def test_interval_bounds_are_included(spark):
    pays = at(spark.createDataFrame([("1", "o", T0)], "id string, o string, pay bigint"),
              "pay")
    offsets = [-901_000, -900_001, -900_000, -450_000, 0, 5_000, 5_001, 6_000]
    details = at(spark.createDataFrame(
        [(str(x), "o", T0 + x) for x in offsets], "d string, o string, t bigint"), "t")
    pairs = interval_join(pays, details, ["o"], "pay", "t", 900, 5)
    assert sorted(int(r.d) for r in pairs.collect()) == [-900_000, -450_000, 0, 5_000]


@pytest.mark.parametrize("before, after", [(0, 0), (1, 0), (10, 3), (60, 60), (3600, 0)])
def test_interval_join_equals_all_pairs(spark, before, after):
    import random
    rnd = random.Random(before + after)
    left = [(i, rnd.choice("xxy"), T0 + rnd.randrange(0, 200_000)) for i in range(80)]
    right = [(i, rnd.choice("xxy"), T0 + rnd.randrange(0, 200_000)) for i in range(80)]
    right += [(100 + i, k, t + after * 1000) for i, k, t in left[:20]]
    pairs = interval_join(
        at(spark.createDataFrame(left, "l int, k string, lt bigint"), "lt"),
        at(spark.createDataFrame(right, "r int, k string, rt bigint"), "rt"),
        ["k"], "lt", "rt", before, after)

    expected = sorted(
        (l, r) for l, k, lt in left for r, k2, rt in right
        if k == k2 and lt - before * 1000 <= rt <= lt + after * 1000)
    assert sorted((p.l, p.r) for p in pairs.collect()) == expected


def test_spread_join_equals_plain_join(spark):
    facts = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    dim = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = spread_join(facts, dim, "k", "id", hot_rows=100, salts=7)
    assert rows(got, "id", "k", "v") == rows(facts.join(dim, "k"), "id", "k", "v")


def test_enrich_and_quarantine(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, k string")
    dim = spark.createDataFrame([("a", "A"), ("c", "C")], "id string, name string")
    assert rows(enrich(facts, dim, "k", {"name": "label"})) == [(1, "a", "A")]
    assert rows(without_dimension(facts, dim, "k")) == [(2, "b"), (3, None)]
    assert rows(enrich_or_mark(facts, dim, "k", {"name": "label"})) == [
        (1, "a", "A", True), (2, "b", None, False), (3, None, None, False)]


def test_latest_per_key_limits_groups_ahead_of_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")],
                               "id string, arrival int, v string")
    last = latest_per_key(df, "id")
    assert rows(last) == [("a", 3, "y"), ("b", 2, "z")]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
