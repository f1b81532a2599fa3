"""Runs a registered query on Spark and its SQL on DuckDB and compares the rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, Decimal)):
        return float(value) if isinstance(value, Decimal) else value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def row_bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(df, db, sql: str) -> str | None:
    """None if both sides give the same rows, else a short account of what differs."""
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = row_bag(names, cursor.fetchall())
    got = row_bag(df.columns, [tuple(r) for r in df.collect()])
    if want == got:
        return None
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; only in Spark {list(extra)[:3]}; "
        f"only in SQL {list(missing)[:3]}"
    )
