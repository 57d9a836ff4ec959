"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from check import TABLES, canonical
from coursemill.plans import catalog

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables")


@pytest.fixture(scope="module")
def db():
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_sql(spark, db, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = db.sql(catalog.ORACLE[name])
    assert sorted(result.columns) == columns
    order = [result.columns.index(c) for c in columns]
    expected = canonical([[r[i] for i in order] for r in result.fetchall()])
    assert canonical(df.select(*columns).collect()) == expected


def test_every_check_has_a_query():
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)
