"""Corpus queries against their SQL at the smallest scale."""

import duckdb
import pytest

from adlake.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    columns = [c[0] for c in cur.description]
    assert sorted(map(tuple, QUERIES[name](spark, sf_small).select(*columns).collect()), key=str) == sorted(cur.fetchall(), key=str)
