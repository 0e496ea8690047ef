"""Registered queries with SQL against DuckDB on the smallest tables."""

import os

import pytest

from onomast.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    found = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted(found.fetchall(), key=repr)
