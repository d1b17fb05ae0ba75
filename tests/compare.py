"""Run registered queries next to their SQL twins and compare the rows."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime):
        return value.isoformat()
    return value if value is None else str(value)


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows sorted, values as text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(row[i]) for i in order) for row in rows]
    out.sort(key=lambda row: tuple("" if v is None else "v" + v for v in row))
    return [columns[i] for i in order], out


def spark_rows(df):
    return canonical(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(connection, sql):
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return canonical(columns, result.fetchall())


def multiset(df):
    """Rows in an order that does not depend on how they were computed."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
