"""The registered queries that SQL expresses, against their DuckDB twins."""

from __future__ import annotations

import os

import duckdb
import pytest

from flowcubes.llm import registry as R

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(R.oracle_sql()))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    res = con.execute(R.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    got = R.queries()[name](spark, DATA).select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(res.fetchall(), key=repr)
