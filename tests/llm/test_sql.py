"""Queries that SQL can express give the same rows as DuckDB."""

import glob
import os

import pytest

from hilada.llm import queries, sql

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    mine, theirs = queries.queries()[name](spark, sf_dir), con.execute(sql.SQL[name]).fetchdf()
    columns = sorted(mine.columns)
    text = lambda rows: sorted(tuple("" if v is None or v != v else str(v) for v in r) for r in rows)
    assert columns == sorted(theirs.columns) and text(mine.select(*columns).collect()) == text(theirs[columns].itertuples(index=False))
