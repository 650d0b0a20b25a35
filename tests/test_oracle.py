"""Every registered query with an oracle, Spark against DuckDB at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    exp = digest([d[0] for d in res.description], res.fetchall())
    assert got[0] == exp[0]
    assert got[1] == exp[1]
    assert got[2] == exp[2]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "comprado" in df.columns
