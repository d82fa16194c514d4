"""Comparison of a Spark result with the result of its SQL in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    database = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return database


def kind(value) -> str:
    """Type family of a value; whole and fractional numbers differ."""
    return {bool: "bool", int: "int", float: "float", str: "text"}.get(type(value), str(type(value)))


def shown(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def rows(columns: list[str], data) -> list[tuple]:
    """Rows with columns in name order, as a sorted list."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    tuples = [tuple((kind(r[i]), shown(r[i])) for i in order) for r in data]
    return sorted(tuples, key=repr)


def compare(df, sql: str, database) -> str | None:
    """None if both results agree, otherwise what differs."""
    cursor = database.execute(sql)
    sql_columns = [item[0] for item in cursor.description]
    if sorted(df.columns) != sorted(sql_columns):
        return f"columns {sorted(df.columns)} against {sorted(sql_columns)}"
    expected = rows(sql_columns, cursor.fetchall())
    found = rows(df.columns, [tuple(r) for r in df.collect()])
    if len(found) != len(expected):
        return f"{len(found)} rows against {len(expected)}"
    for a, b in zip(found, expected, strict=True):
        if a != b:
            return f"{a} against {b}"
    return None
