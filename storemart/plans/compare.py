"""Spark-vs-DuckDB result comparison (row count, columns, order-insensitive values).

Used by the tests and by ``scripts/check_oracle.py``; mirrors the driver's
correctness gate so that a query can be checked before it is registered.
"""

from __future__ import annotations

import decimal
import math

import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.10g}")
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if isinstance(v, (list, tuple)):
        return str([_norm(x) for x in v])
    return v


def _rows(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for _, r in df[cols].iterrows()]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> dict:
    out = {"spark_rows": len(spark_pdf), "oracle_rows": len(duck_pdf),
           "columns_match": sorted(spark_pdf.columns) == sorted(duck_pdf.columns)}
    if not out["columns_match"]:
        out["spark_only"] = sorted(set(spark_pdf.columns) - set(duck_pdf.columns))
        out["oracle_only"] = sorted(set(duck_pdf.columns) - set(spark_pdf.columns))
        out["ok"] = False
        return out
    a, b = _rows(spark_pdf), _rows(duck_pdf)
    out["values_match"] = a == b
    if not out["values_match"] and len(a) == len(b):
        cols = sorted(spark_pdf.columns)
        bad = {cols[i] for ra, rb in zip(a, b) for i in range(len(cols)) if ra[i] != rb[i]}
        out["mismatch_columns"] = sorted(bad)
        for ra, rb in zip(a, b):
            if ra != rb:
                out["first_diff"] = [(cols[i], ra[i], rb[i]) for i in range(len(cols)) if ra[i] != rb[i]][:5]
                break
    out["ok"] = out["columns_match"] and out["values_match"] and len(a) == len(b)
    return out
