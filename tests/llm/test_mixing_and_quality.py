import math

from pyspark.sql import functions as F

from coursemill.llm import mixing, quality

SCHEMA = "doc_id long, text string, source string, size string, target int, _x int, n_words int"


def test_mix_with_nulls_repeats_and_clashing_columns(spark):
    rows = [(i, "w " * (i % 7), "ab"[i % 2] if i % 5 else None, "s", 1, 2, 3) for i in range(200)]
    rows += [(3, "w w w", "a", "s", 1, 2, 3)] * 3 + [(None, "w w", None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    totals, taken = {}, {}
    for r in got:
        assert r.size == len((r.text or "").split()) and 0 <= r.taken <= 2 * r.size
        totals[r.source] = totals.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for r in got:
        assert r.source_size == totals[r.source]
        assert taken[r.source] == math.floor(r.target) and r.target <= 2 * r.source_size
    assert abs(sum({r.source: r.target for r in got}.values()) - 1.5 * sum(totals.values())) < 1e-6
    again = mixing.mix(df.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.text or "", r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_documents_have_the_taken_words(spark):
    rows = [(i, f"w{i} " * 9, "ab"[i % 2], 18) for i in range(40)] + [(99, None, "a", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    taken = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    out = mixing.mixed(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType.typeName() == "integer"
    words = {}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {i: n for i, n in taken.items() if n}


def test_targets_are_shared_again_until_none_is_above(spark):
    sizes = spark.createDataFrame(
        [("a", 10), ("b", 1000), ("c", 500), (None, 40), ("d", 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got["a"] == 20 and got["d"] == 0 and abs(sum(got.values()) - 1.5 * 1550) < 1e-9
    assert all(t <= 2 * s for t, s in zip(
        (got["b"], got["c"], got[None]), (1000, 500, 40), strict=True))


def test_quality_keeps_columns_and_cleans(spark):
    good = "\n".join(" ".join(f"word{k}x{j}" for j in range(12)) + "." for k in range(9))
    rows = [(1, good + "\nHome | News | About | Contact | Log in", 7), (2, None, 7), (3, good, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int").withColumn(
        "extra", F.lit("x"))
    got = {r.doc_id: r for r in quality.measure(df).collect()}
    assert got[1].kept and got[1].cleaned == good and got[1].n_lost_words == 10
    assert not got[2].kept and got[2].cleaned == "" and got[3].cleaned == good
    assert set(df.columns) <= set(quality.measure(df).columns)
