"""Spark-vs-DuckDB comparison used by the tests (same idea as the driver's
check: row count, column names, order-insensitive values)."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{round(v, 6):.6f}")
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (1, f"{float(v):.6f}")
    if isinstance(v, dt.datetime):
        return (3, v.isoformat())
    if isinstance(v, dt.date):
        return (3, v.isoformat())
    return (4, str(v))


def rows_of(columns, rows, drop=()):
    idx = sorted((c, i) for i, c in enumerate(columns) if c not in drop)
    names = [c for c, _ in idx]
    out = sorted(tuple(_norm(r[i]) for _, i in idx) for r in rows)
    return names, out


def compare(spark_df, con, sql, drop=()):
    s_cols, s_rows = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()], drop)
    res = con.sql(sql)
    d_cols, d_rows = rows_of(res.columns, res.fetchall(), drop)
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count differs: spark={len(s_rows)} duck={len(d_rows)}")
    elif s_rows != d_rows:
        bad = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, e.g. {bad}")
    return problems
