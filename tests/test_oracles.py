"""Every query against its SQL over the smallest test tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import database, spark_rows, sql_rows
from conftest import TABLES

QUERIES, SQLS = queries(), oracle_sql()


@pytest.fixture(scope="module")
def db():
    return database(TABLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    df = QUERIES[name](spark, TABLES)
    rows = spark_rows(df)
    if name in SQLS:
        types, expected = sql_rows(db, SQLS[name])
        assert set(types) == set(df.columns)
        assert rows == expected
    else:
        assert rows


def test_entry(spark):
    assert entry(spark).count() > 0
