"""Every query against its SQL, on the smallest tables and on odd ones."""

import os

import duckdb
import pytest

from check import TABLES, canonical
from coursemill.llm import queries

FOLDER = "/root/testdata/sf0.001"
LINES = "Read more | Home | News | Log in\nA line with an end.\nA line with an end.\n"
ODD = [
    (1, None, "en", None, None), (2, "", "en", "b", 0), (3, " \n\t\x0b", None, "b", 4),
    (4, "word", "de", "a", 4), (5, "word", "de", "a", 4), (6, "a b c " * 60, "en", "Z", 360),
    (7, LINES + "x " * 40 + "the end.", "en", "é", 9), (8, "SHOUT!! LOUD!! " * 30, "en", "z", 1),
    (9, "one two three four. " * 20 + "\n" + "#$% " * 90, "en", "a", 9),
    (10, "😀 é ü! x@y.zz +49 (30) 12345678 é 10.0.0.256 1.2.3.4 4111 1111 1111 1111", "en", "a", 1),
    (11, "\n".join(f"Line number {k} of a longer text here." for k in range(30)), "fr", None, 3),
    (12, "w" * 5000 + " " + "v " * 3000, "en", "b", 11000),
]


def compare(spark, db, name, folder):
    df = queries.QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    result = db.sql(queries.ORACLE[name])
    assert sorted(result.columns) == columns
    order = [result.columns.index(c) for c in columns]
    assert canonical(df.select(*columns).collect()) == canonical(
        [[r[i] for i in order] for r in result.fetchall()])


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    compare(spark, db, name, FOLDER)


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_documents_match_sql(spark, folder, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    for name in sorted(queries.ORACLE):
        if name not in ("op10_warc_fixity", "op13_conversations"):
            compare(spark, db, name, folder)


def test_all_operators_are_registered():
    assert {int(name[2:].split("_")[0]) for name in queries.QUERIES} == set(range(1, 14))
