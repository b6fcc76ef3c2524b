"""Every registered query equals its DuckDB oracle on the smallest tables
(row count, column names, order-insensitive values); rows-only queries run."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_mod
from aerocast.plans import catalog
from conftest import SF_SMALL
from tools.check_oracles import TABLES, rows_of

# the queries of the subpackage llm have their own tests
QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_catalogue_complete():
    assert len(QUERIES) >= 56
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLES) <= set(entry_mod.oracle_sql())
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)  # every query has an oracle


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0 and "category" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert rows_of(df.columns, srows) == rows_of(ocols, orows)
