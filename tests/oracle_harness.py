"""Run registered queries in Spark and their DuckDB twins; compare like the driver
(column names sorted, row count, order-insensitive values)."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dt.date):  # DuckDB's pandas export turns DATE into datetime
        return dt.datetime(v.year, v.month, v.day)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    a, b = sorted(spark_pdf.columns), sorted(duck_pdf.columns)
    if a != b:
        return False, f"columns differ: spark={a} duck={b}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"rows differ: spark={len(spark_pdf)} duck={len(duck_pdf)}"
    ra, rb = rows_of(spark_pdf), rows_of(duck_pdf)
    bad = [(x, y) for x, y in zip(ra, rb) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{len(ra)} rows"
