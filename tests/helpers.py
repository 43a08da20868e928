"""Comparison of a query with its SQL over a folder of tables."""

import math
import os

import duckdb

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, list):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "as_tuple"):
        return float(f"{float(v):.9g}")
    return v


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(plain(x) for x in r) for r in df.select(*(f"`{c}`" for c in cols)).collect()), key=str)


def sql_rows(sql, folder=DATA):
    con = duckdb.connect()
    for f in sorted(os.listdir(folder)):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{f}'")
    got = con.execute(sql)
    names = [x[0] for x in got.description]
    at = [names.index(c) for c in sorted(names)]
    return sorted(names), sorted((tuple(plain(r[i]) for i in at) for r in got.fetchall()), key=str)
