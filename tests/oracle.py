"""Comparing a Spark result with DuckDB over the same tables."""

from __future__ import annotations

import contextlib
import io
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def plan(df: DataFrame) -> str:
    """The formatted physical plan."""
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain("formatted")
    return shown.getvalue()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    return str(value)


def _rows(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, types of numbers and all rows agree."""
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(columns)}"]
    ours, theirs = _rows(df.collect(), df.columns), _rows(cursor.fetchall(), columns)
    if ours == theirs:
        return []
    return [
        f"{sum(ours.values())} rows against {sum(theirs.values())}, columns {sorted(columns)}",
        *[f"only spark {row}" for row in list((ours - theirs))[:3]],
        *[f"only sql   {row}" for row in list((theirs - ours))[:3]],
    ]
