"""Compares query results with DuckDB: columns by name, rows as a multiset."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from typing import Any

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value: Any) -> Any:
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, (int, float)):
        return "NaN" if isinstance(value, float) and math.isnan(value) else round(float(value), 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return str(value)


def rows_of(columns: list[str], rows: Any) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df: Any, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both agree, else what differs."""
    got = rows_of(df.columns, df.collect())
    rel = con.sql(sql)
    if sorted(rel.columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(rel.columns)}"
    want = rows_of(rel.columns, rel.fetchall())
    if got == want:
        return None
    extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
    return f"{sum(got.values())} vs {sum(want.values())} rows; only ours {extra}; only oracle {missing}"
