"""Side-by-side comparison of a Spark result with DuckDB on the same files."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb


def duckdb_on(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def plain(value: object) -> object:
    """A value both engines print alike, exact except for the last bits of doubles."""
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, decimal.Decimal):
        return f"{value:f}"
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return str(value)


def table(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def spark_table(df) -> tuple[list[str], list[tuple]]:
    return table(df.columns, [tuple(row) for row in df.collect()])


def duckdb_table(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return table(columns, result.fetchall())
