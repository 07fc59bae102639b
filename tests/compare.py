"""Run a query on Spark and its SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> str | None:
    """None when both results hold the same rows, else a short explanation."""
    result = connection.execute(sql)
    expected_columns = [column[0] for column in result.description]
    expected_types = {c[0]: str(c[1]) for c in result.description}
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_columns)}"
    names = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "string": "VARCHAR",
        "timestamp_ntz": "TIMESTAMP",
        "date": "DATE",
        "boolean": "BOOLEAN",
    }
    types = {name: names.get(kind, kind) for name, kind in df.dtypes}
    if types != expected_types:
        different = {n: (types[n], expected_types[n]) for n in types if types[n] != expected_types[n]}
        return f"types differ (spark, duckdb): {different}"
    expected = _rows(expected_columns, result.fetchall())
    actual = _rows(df.columns, df.collect())
    if actual == expected:
        return None
    return (
        f"{sum(actual.values())} rows, expected {sum(expected.values())}; "
        f"extra {list((actual - expected).items())[:2]}; "
        f"missing {list((expected - actual).items())[:2]}"
    )
