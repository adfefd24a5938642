"""Comparing a Spark result with the SQL counterpart in DuckDB."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sorted(pdf):
    pdf = pdf[sorted(pdf.columns)].copy()
    for c in pdf.columns:
        if pdf[c].dtype == object or str(pdf[c].dtype).startswith(("datetime", "str")):
            pdf[c] = pdf[c].map(lambda v: None if pd.isna(v) else str(v)[:10] if hasattr(v, "year") else str(v))
    return pdf.sort_values(list(pdf.columns), na_position="first").reset_index(drop=True)


def differences(df, con, sql):
    """An empty list if both results have the same columns, types and rows."""
    kinds = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "INTEGER": "int",
             "BOOLEAN": "boolean"}
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    expected_types = {r[0]: kinds.get(r[1], r[1]) for r in described}
    actual_types = dict(df.dtypes)
    if expected_types != actual_types:
        return [f"types: {actual_types} != {expected_types}"]
    actual, expected = _sorted(df.toPandas()), _sorted(con.execute(sql).df())
    if len(actual) != len(expected):
        return [f"rows: {len(actual)} != {len(expected)}"]
    found = []
    for c in expected.columns:
        a, e = actual[c], expected[c]
        if expected_types[c] == "double":
            same = np.array_equal(a.to_numpy(float), e.to_numpy(float), equal_nan=True)
        else:
            same = [None if pd.isna(v) else v for v in a] == [None if pd.isna(v) else v for v in e]
        if not same:
            found.append(c)
    return [f"values differ: {found}"] if found else []
