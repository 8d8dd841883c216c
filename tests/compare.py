"""Comparing a Spark result with DuckDB SQL over the same files."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "part", "orders", "lineitem"]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.date()
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """What differs between the two results, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    expected, found = _bag(names, result.fetchall()), _bag(df.columns, df.collect())
    if expected == found:
        return None
    less, more = expected - found, found - expected
    return (
        f"{sum(found.values())} rows against {sum(expected.values())}; missing {len(less)}: "
        f"{list(less)[:2]}; unexpected {len(more)}: {list(more)[:2]}"
    )
