"""Every query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from voltaweave.plans import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events pages".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([columns[i] for i in order]), sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF_DIR)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got[1], "no rows"
    if name in catalog.ORACLE_SQL:
        result = duck.execute(catalog.ORACLE_SQL[name])
        assert got == rows_of([c[0] for c in result.description], result.fetchall())
