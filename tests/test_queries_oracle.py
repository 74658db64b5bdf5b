"""Every registered query against its DuckDB SQL on sf0.001 (the driver's gate, locally)."""

import json

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(rows):
    def n(v):
        if isinstance(v, float):
            return round(v, 6)
        if hasattr(v, "isoformat"):
            return v.isoformat()
        if v.__class__.__name__ == "Decimal":
            return str(v.normalize())
        return v
    return sorted(json.dumps([n(x) for x in r], default=str) for r in rows)


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    cols = df.columns
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    s_rows = [tuple(r[c] for c in sorted(cols)) for r in df.collect()]
    idx = [dcols.index(c) for c in sorted(cols)]
    d_rows = [tuple(r[i] for i in idx) for r in res.fetchall()]
    assert _norm(s_rows) == _norm(d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "SubStatus" in df.columns
