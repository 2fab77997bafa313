"""Order-insensitive comparison of a Spark DataFrame with a DuckDB query."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    return v


def rows_of(records, cols, digits=6):
    out = []
    for r in records:
        out.append(tuple(_norm(r[c], digits) for c in cols))
    return sorted(out, key=repr)


def compare(spark_df, con, sql, digits=6):
    s_cols = sorted(spark_df.columns)
    rel = con.sql(sql)
    d_cols = sorted(rel.columns)
    assert s_cols == d_cols, f"columns differ: spark={s_cols} duck={d_cols}"
    s_rows = rows_of([r.asDict() for r in spark_df.collect()], s_cols, digits)
    d_recs = [dict(zip(rel.columns, t)) for t in rel.fetchall()]
    d_rows = rows_of(d_recs, s_cols, digits)
    return s_rows, d_rows
