"""Compare registered queries with their oracle SQL on one folder of sample parquet files."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def open_oracle(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.17g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value) if isinstance(value, dt.date) else value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(body, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def compare(spark_df, db, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_columns, got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = db.execute(sql)
    want_columns, want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {sorted(set(got_columns) ^ set(want_columns))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for left, right in zip(got, want, strict=True):
        if left != right:
            bad = [(c, a, b) for c, a, b in zip(got_columns, left, right, strict=True) if a != b]
            return f"{bad[:4]} in {left}"
    return None
