"""Every registered query with SQL against DuckDB on the smallest tables."""

import os

import pytest

from onomast.plans import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in ("lineitem", "part", "events", "documents", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in queries.ORACLE_SQL:
        assert len(df.columns) == len(set(df.columns)) and len(rows) > 0
        return
    found = duck.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted((tuple(r[c] for c in columns) for r in rows), key=repr) == sorted(found.fetchall(), key=repr)
