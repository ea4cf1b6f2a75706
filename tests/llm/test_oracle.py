"""The operators' queries against their SQL on the same files."""

import duckdb
import pytest

from closebook.llm.oracle import SQL
from closebook.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    cur = con.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    want = sorted(map(repr, cur.fetchall()))
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(repr(tuple(r)) for r in df.select(columns).collect()) == want and want
