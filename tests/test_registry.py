"""Every registered query runs at sf0.001 and matches its SQL oracle."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from adlake.plans.registry import QUERIES as OWN  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
ALL, SQL = E.queries(), E.oracle_sql()
# The corpus operators, where present, have tests of their own.
QUERIES = {n: q for n, q in ALL.items() if n in OWN}
ORACLE = {n: q for n, q in SQL.items() if n in OWN}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "payload" in df.columns


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert rows_of(df.columns, srows) == rows_of(ocols, cur.fetchall())
