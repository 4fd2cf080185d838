"""Holds a query's rows against its SQL, run by DuckDB over the same tables."""

import os

import duckdb
import pandas as pd

SF_DIR = "/root/testdata/sf0.001"


def tables(sf_dir=SF_DIR):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf_dir}/{name}')")
    return con


def rows(frame, columns):
    def plain(x):
        return None if x is None or not isinstance(x, list) and pd.isna(x) else round(x, 6) if isinstance(x, float) else x

    return sorted(repr([plain(x) for x in row]) for row in frame[columns].astype(object).itertuples(index=False))


def assert_same(con, frame, sql):
    other = con.execute(sql).df()
    columns = sorted(frame.columns)
    assert columns == sorted(other.columns)
    assert rows(frame, columns) == rows(other, columns)
