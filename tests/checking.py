"""Comparison of query results with DuckDB."""

from __future__ import annotations

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

from millrace.queries.inputs import TABLES


def duckdb_views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def in_order(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows[sorted(rows.columns)]
    return rows.sort_values(list(rows.columns)).reset_index(drop=True)


def assert_same(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    expected, actual = in_order(con.execute(sql).df()), in_order(result.toPandas())
    assert list(expected.columns) == list(actual.columns)
    assert len(expected) == len(actual)
    assert len(expected) > 0
    for name in expected.columns:
        left, right = expected[name], actual[name]
        assert (left.isna() == right.isna()).all(), name
        left, right = left.dropna(), right.dropna()
        if pd.api.types.is_numeric_dtype(left):
            assert pd.api.types.is_numeric_dtype(right), name
            assert (left.astype(float) == right.astype(float)).all(), name
        elif pd.api.types.is_datetime64_any_dtype(left):
            assert (left.astype("datetime64[us]") == right.astype("datetime64[us]")).all(), name
        else:
            assert (left == right).all(), name
