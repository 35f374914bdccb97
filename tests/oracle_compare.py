"""Side-by-side check of ``queries()`` against ``oracle_sql()`` (DuckDB), as the driver does."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark_df, con, sql: str):
    """Returns (ok, message)."""
    s_cols = spark_df.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_raw = rel.fetchall()
    idx = {c: i for i, c in enumerate(d_cols)}
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    d_rows = [tuple(_norm(r[idx[c]]) for c in sorted(d_cols)) for r in d_raw]
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}"
    s_sorted, d_sorted = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    for a, b in zip(s_sorted, d_sorted):
        if a != b:
            return False, f"first difference: spark={a} duck={b}"
    return True, f"{len(s_rows)} rows"
