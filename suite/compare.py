"""Run Spark queries and their DuckDB twins and compare the results."""

from __future__ import annotations

import datetime
import decimal

import duckdb
from pyspark.sql import DataFrame

from suite.fixtures import BASE


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v if isinstance(v, int) else str(v)


def _rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in data), key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both results agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    kinds = {d[0]: str(d[1]).lower() for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    spelled = {"varchar": "string", "integer": "int"}
    types = {}
    for c, t in df.dtypes:
        kind = spelled.get(kinds[c], kinds[c])
        if kind != t.replace("timestamp_ntz", "timestamp"):
            types[c] = (t, kind)
    actual = _rows(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}; types {types}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"row {a} against {e}; types {types}"
    return f"types {types}" if types else None
