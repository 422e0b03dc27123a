"""The queries that DuckDB can express, against their SQL on driver tables."""

import os

import pytest

from voltaweave.llm import queries

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_is_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, DIR).select(*columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)
