"""Order-insensitive comparison of a Spark result with a DuckDB oracle result.

Used by the tests (and by hand while developing); mirrors what the driver's
correctness gate checks: row count, column names, and values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9) + 0.0
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def normalize(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark_df, con, sql: str):
    """-> (ok, message)."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    a_cols, a = normalize(s_cols, s_rows)
    _, b = normalize(d_cols, d_rows)
    if len(a) != len(b):
        return False, f"row count spark={len(a)} duck={len(b)}"
    if a != b:
        diff = [x for x, y in zip(a, b) if x != y][:3]
        other = [y for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({a_cols}): spark {diff} vs duck {other}"
    return True, f"{len(a)} rows match"
