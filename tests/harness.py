"""Driver-like comparison of a Spark query with its DuckDB twin."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and not isinstance(v, (pd.Timestamp,)):
        v = v.item()
    if isinstance(v, bool):
        return float(v)
    if isinstance(v, (int, float)):
        return None if (isinstance(v, float) and math.isnan(v)) else float(v)
    return v


def compare(spark_df, con, sql: str):
    """(ok, message): row count, column names and multiset of rows equal."""
    pdf = spark_df.toPandas()
    odf = con.execute(sql).fetchdf()
    if sorted(pdf.columns) != sorted(odf.columns):
        return False, f"columns differ: spark={sorted(pdf.columns)} oracle={sorted(odf.columns)}"
    cols = sorted(pdf.columns)
    if len(pdf) != len(odf):
        return False, f"rows differ: spark={len(pdf)} oracle={len(odf)}"
    a = sorted((tuple(_canon(x) for x in r) for r in pdf[cols].astype(object).itertuples(index=False)), key=repr)
    b = sorted((tuple(_canon(x) for x in r) for r in odf[cols].astype(object).itertuples(index=False)), key=repr)
    for ra, rb in zip(a, b):
        if ra != rb:
            diff = {c: (x, y) for c, x, y in zip(cols, ra, rb) if x != y}
            return False, f"first differing row: {diff}"
    return True, f"{len(pdf)} rows equal"
