"""Every query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from quadrille.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    return c


def rows(records, columns):
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted(repr([plain(r[c]) for c in columns]) for r in records)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query(spark, con, name):
    got = [r.asDict() for r in catalogue.QUERIES[name](spark, SF).collect()]
    cur = con.execute(catalogue.ORACLE_SQL[name])
    columns = [c[0] for c in cur.description]
    want = [dict(zip(columns, r)) for r in cur.fetchall()]
    assert want and sorted(got[0]) == sorted(columns)
    assert rows(got, sorted(columns)) == rows(want, sorted(columns))


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
