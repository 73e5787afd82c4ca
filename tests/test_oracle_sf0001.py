"""Registered queries against their DuckDB oracle on sf0.001 (the driver's check, smaller)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
import oracle_sql as oracle
from corate.plans import registry
from tests.conftest import SF_SMALL

TABLES = ["part", "orders", "lineitem", "documents", "events"]
CHECKED = sorted(oracle.ORACLE)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda k: cols[k])

    def fix(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v

    return sorted((tuple(fix(r[k]) for k in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _norm(df.collect(), df.columns) == _norm(res.fetchall(), ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id1", "id2", "similarity"]
    assert df.count() == 27


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(oracle.ORACLE)
    assert set(registry.QUERIES) <= set(entry.queries()) and set(oracle.ORACLE) <= set(entry.oracle_sql())
