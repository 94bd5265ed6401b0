"""Comparing a query with its SQL, row by row and independent of order."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with every Parquet file of ``sf_dir`` as a view."""
    connection = duckdb.connect()
    connection.execute("SET threads TO 4")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(item) for item in value)
    return value


def as_bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


#: Type names of both engines, brought to one spelling.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def mismatch(df, connection, sql: str) -> str | None:
    """None if ``df`` and ``sql`` agree in names, types and rows, else what differs."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    types = {column[0]: str(column[1]) for column in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns: {sorted(set(names) ^ set(df.columns))}"
    for name, data_type in df.dtypes:
        if TYPES.get(data_type, data_type) != types[name]:
            return f"type of {name}: {data_type} against {types[name]}"
    actual = df.collect()
    wanted, got = as_bag(names, expected), as_bag(df.columns, actual)
    if wanted != got:
        missing, extra = list((wanted - got).items())[:2], list((got - wanted).items())[:2]
        return f"rows: {len(actual)} against {len(expected)}\n missing {missing}\n extra {extra}"
    if not expected:
        return "no rows to compare" if "gate" not in sql else None
    return None
