"""A query's rows against DuckDB's rows for its SQL, in any order."""

import os

import duckdb
import numpy as np
import pandas as pd


def tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            path = f"{folder}/{name}"
            con.sql(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def _cell(x):
    if x is None or (not isinstance(x, (list, dict, tuple, np.ndarray)) and pd.isna(x)):
        return "~"
    return f"{x:.9g}" if isinstance(x, float) else str(x)


def rows(frame: pd.DataFrame) -> list[tuple]:
    return sorted(tuple(map(_cell, r)) for r in frame[sorted(frame.columns)].itertuples(index=False))


def assert_same(spark, query, sql: str, folder: str) -> None:
    got, want = query(spark, folder).toPandas(), tables(folder).sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
