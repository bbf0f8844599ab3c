"""Run a query and its SQL side by side."""

from __future__ import annotations

import datetime as dt

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events"
    " documents embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def normal_rows(names: list[str], rows) -> list[tuple]:
    """Rows with their columns by name, in an order of their own."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df: DataFrame) -> list[tuple]:
    return normal_rows(df.columns, df.collect())


def sql_rows(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[dict[str, str], list[tuple]]:
    """Column types by name, and the rows."""
    result = db.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    return types, normal_rows(list(types), result.fetchall())
