"""Queries against their SQL."""

import duckdb
import pytest

from snapflow.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    cols = ", ".join(got.columns)
    want = sorted(con.execute(f"SELECT {cols} FROM ({SQL[name]})").fetchall())
    assert sorted(map(tuple, got.collect())) == want
