"""Side-by-side check of a registered query against its DuckDB twin,
in the manner of the driver: row count, column names and an
order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def digest(cols: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), sorted(cols), h


def compare(spark, sf_dir: str, name: str, fn, sql: str, con=None):
    con = con or duck(sf_dir)
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    drows = rel.fetchall()
    s = digest(sdf.columns, srows)
    d = digest(list(rel.columns), drows)
    return s, d, srows, drows, sdf.columns, list(rel.columns)
