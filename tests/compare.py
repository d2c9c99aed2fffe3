"""Compare a Spark result with DuckDB's: column names, and rows as a multiset."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return round(float(value), 6)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def row_counts(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both agree, else a short text."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = row_counts(cursor.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    got = row_counts([tuple(r) for r in df.collect()], df.columns)
    if got != expected:
        extra, lacking = got - expected, expected - got
        return (
            f"{got.total()} rows, expected {expected.total()}; columns {sorted(names)}; "
            f"extra {extra.total()} {list(extra)[:2]}; lacking {lacking.total()} {list(lacking)[:2]}"
        )
    return None
