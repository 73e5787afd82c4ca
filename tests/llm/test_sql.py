"""Corpus queries against their DuckDB SQL on sf0.001."""

import duckdb
import pytest

from corate.llm import queries, sql

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(sql.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(sql.ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r) for r in got.select(columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
