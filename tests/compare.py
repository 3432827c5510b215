"""Spark result vs DuckDB oracle: row count, column names, sorted values."""

from __future__ import annotations

import datetime as _dt
import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return round(v, 9)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    return v


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=repr)
    return [columns[i] for i in order], out


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr = _canon(s_cols, s_rows)
    dc, dr = _canon(d_cols, d_rows)
    problems = []
    if sc != dc:
        problems.append(f"columns {sc} != {dc}")
    if len(sr) != len(dr):
        problems.append(f"rows {len(sr)} != {len(dr)}")
    elif sr != dr:
        diff = next(i for i, (a, b) in enumerate(zip(sr, dr)) if a != b)
        problems.append(f"values differ at {diff}: {sr[diff]} != {dr[diff]}")
    return problems, len(sr), len(dr)
