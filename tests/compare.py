"""Spark result vs DuckDB oracle: row count, column names, order-free values."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.6g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], sorted(columns)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_rows = spark_df.collect()
    s_cols = spark_df.columns
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    a, ca = rows_of(s_cols, [tuple(r) for r in s_rows])
    b, cb = rows_of(d_cols, d_rows)
    if ca != cb:
        return False, f"columns differ: spark={ca} oracle={cb}"
    if len(a) != len(b):
        return False, f"row count differs: spark={len(a)} oracle={len(b)}"
    ca_, cb_ = Counter(a), Counter(b)
    if ca_ != cb_:
        only_a = list((ca_ - cb_).elements())[:3]
        only_b = list((cb_ - ca_).elements())[:3]
        return False, f"values differ: spark-only={only_a} oracle-only={only_b}"
    return True, f"{len(a)} rows"
