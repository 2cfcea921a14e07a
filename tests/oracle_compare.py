"""Compare a registered Spark query with its DuckDB twin, as the driver does:
row count, column names (sorted), and an order-insensitive value hash."""

from __future__ import annotations

import hashlib
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{v:.6g}"
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if hasattr(v, "item"):
        try:
            return _norm(v.item())
        except Exception:
            pass
    return str(v)


def _rows_hash(cols: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode("utf-8", "surrogatepass"))
        h.update(b"\n")
    return h.hexdigest()


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    out = {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "spark_cols": s_cols,
        "oracle_cols": d_cols,
    }
    out["rows_match"] = out["spark_rows"] == out["oracle_rows"]
    out["hash_match"] = out["cols_match"] and _rows_hash(s_cols, s_rows) == _rows_hash(d_cols, d_rows)
    if not out["hash_match"] and out["cols_match"]:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        sa = sorted(tuple(_norm(r[i]) for i in order_s) for r in s_rows)
        da = sorted(tuple(_norm(r[i]) for i in order_d) for r in d_rows)
        sset, dset = set(sa), set(da)
        out["only_spark"] = [x for x in sa if x not in dset][:3]
        out["only_oracle"] = [x for x in da if x not in sset][:3]
    return out
