"""Runs a query and its SQL over the same tables and compares their rows."""

import glob
import math
import os

import duckdb
import pandas as pd


def _cell(v):
    if v is None:
        return None
    if isinstance(v, float) or type(v).__name__.startswith("float"):
        return None if math.isnan(v) else int(v) if v == int(v) and abs(v) < 1e15 else round(float(v), 6)
    if hasattr(v, "tolist") and hasattr(v, "__len__"):
        return str(v.tolist())
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v.item() if hasattr(v, "item") else v


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted((tuple(_cell(v) for v in r) for r in df.itertuples(index=False)), key=repr)


def connect(folder):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for f in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def same(spark, folder, query, sql):
    got, want = query(spark, folder).toPandas(), connect(folder).sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
