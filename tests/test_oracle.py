"""Each query with SQL gives the same rows as DuckDB on the same tables."""

import glob
import os

import pandas as pd
import pytest

from hilada.plans import queries as P

duckdb = pytest.importorskip("duckdb")


def plain(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: "NULL" if v is None or v is pd.NA or v != v else repr(float(v)) if isinstance(v, float) else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.fixture(scope="module")
def connection(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(P.SQL))
def test_query_equals_sql(spark, sf_dir, connection, name):
    mine, theirs = plain(P.QUERIES[name](spark, sf_dir).toPandas()), plain(connection.execute(P.SQL[name]).fetchdf())
    pd.testing.assert_frame_equal(mine, theirs, check_dtype=False)


@pytest.mark.parametrize("name", sorted(set(P.QUERIES) - set(P.SQL)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert P.QUERIES[name](spark, sf_dir).count() > 0


def test_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns[:3] == ["ranking", "token", "word"]
