"""Every query of the engine against its SQL twin on the smallest tables."""

import os

import duckdb
import pytest

from lintel.plans import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return str(v) if isinstance(v, (list, tuple, dict)) else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for f in os.listdir(SF):
        c.sql(f"create view {f.split('.')[0]} as select * from read_parquet('{SF}/{f}')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    if name in ORACLE_SQL:
        want = con.sql(ORACLE_SQL[name])
        at = [want.columns.index(c) for c in cols]
        assert sorted(want.columns) == cols
        assert rows == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)


def test_entry_imports():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and "building_summary" in e.queries()
