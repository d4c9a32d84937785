"""Every registered query against its DuckDB oracle on the small test tables."""
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

duckdb = pytest.importorskip("duckdb")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


# the smallest tables have no such row; larger ones do
EMPTY_HERE: set[str] = set()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[0] == "o_orderkey"


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    from tools.check_oracle import digest
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    assert rows or name in EMPTY_HERE, "a query without rows proves nothing"
    sql = E.oracle_sql().get(name)
    if sql is None:
        return
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows) == digest(dcols, drows)
