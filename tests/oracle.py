"""Comparison of a query with its SQL twin."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    plain = lambda v: None if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v) else v
    rows = [tuple(plain(v) for v in row) for row in pdf.astype(object).itertuples(index=False, name=None)]
    return sorted(rows, key=lambda t: tuple((v is None, str(type(v).__name__), v if v is not None else 0) for v in t))


def differences(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> str | None:
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} / {sorted(sql_pdf.columns)}"
    if len(spark_pdf) != len(sql_pdf):
        return f"rows {len(spark_pdf)} / {len(sql_pdf)}"
    kinds = {
        c: (str(spark_pdf[c].dtype), str(sql_pdf[c].dtype))
        for c in spark_pdf.columns
        if str(spark_pdf[c].dtype) != str(sql_pdf[c].dtype)
    }
    a, b = _rows(spark_pdf), _rows(sql_pdf)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, e.g. {bad[:3]}; types {kinds}"
    return f"types {kinds}" if kinds else None
