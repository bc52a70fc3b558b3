"""Spark-vs-DuckDB comparison (row count, column names, order-insensitive values)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


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
            return None
        return repr(round(v, 6) + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6) + 0.0)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                 key=lambda t: tuple("" if x is None else x for x in t))
    return cols, out


def digest(rows: list[tuple]) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()


def compare(spark_df, con, sql: str) -> dict:
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_cols, s_rows = canonical(spark_df.columns, s_rows)
    res = con.execute(sql)
    d_cols_raw = [c[0] for c in res.description]
    d_cols, d_rows = canonical(d_cols_raw, res.fetchall())
    out = {
        "rows_spark": len(s_rows), "rows_oracle": len(d_rows),
        "cols_match": s_cols == d_cols,
        "values_match": digest(s_rows) == digest(d_rows),
    }
    if not out["values_match"]:
        s_set, d_set = set(s_rows), set(d_rows)
        diff_s = [r for r in s_rows if r not in d_set][:3]
        diff_d = [r for r in d_rows if r not in s_set][:3]
        out["example_spark_only"] = diff_s
        out["example_oracle_only"] = diff_d
        out["cols"] = (s_cols, d_cols)
    return out
