"""Side-by-side check of a catalogue query against its SQL twin on DuckDB
(used by tests and by hand; the driver runs its own comparison)."""

from __future__ import annotations

import math

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duckdb_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if not hasattr(v, "hour") else v.isoformat()
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, sql: str, con) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        out["match"] = False
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["match"] = a == b
    if not out["match"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = sorted(sa - sb)[:3]
        out["only_oracle"] = sorted(sb - sa)[:3]
        out["cols"] = sorted(s_cols)
    return out
