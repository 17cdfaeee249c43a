"""Every registered query against its DuckDB text on the smallest data folder."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from taxaloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]
QUERIES, ORACLE = catalog.QUERIES, entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def text(v):
    return repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted(tuple(text(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    if name not in ORACLE:
        assert rows
        return
    rel = duck.sql(ORACLE[name])
    names = list(rel.columns)
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert rows == sorted(tuple(text(r[i]) for i in at) for r in rel.fetchall())

