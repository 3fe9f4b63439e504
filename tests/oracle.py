"""Run queries in Spark and DuckDB over the same files and compare the results."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"create view {table} as select * from read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        # -0.0 and 0.0 are one value
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


KINDS = {
    "bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "boolean": "boolean",
    "timestamp_ntz": "timestamp",
}


def compare(df, connection, sql: str) -> str | None:
    """A description of the first difference, or ``None``."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]).lower() for d in result.description}
    if sorted(names) != sorted(df.columns):
        return f"columns: {sorted(df.columns)} against {sorted(names)}"
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} against {kinds[name]}"
    ours, theirs = normal(df.columns, df.collect()), normal(names, result.fetchall())
    if len(ours) != len(theirs):
        return f"rows: {len(ours)} against {len(theirs)}"
    for left, right in zip(ours, theirs):
        if left != right:
            return f"{left} against {right}"
    return None
