"""Queries of the operators that SQL can express, against it on the smallest tables."""

import os

import duckdb
import pytest

from geolist.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    res = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == sorted(res.fetchall(), key=repr)
