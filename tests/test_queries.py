"""Every registered query of the library against its SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from geolist.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


def plain(v):
    if type(v).__name__ == "Decimal":
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLE:
        assert got
        return
    res = con.execute(ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in res.fetchall()), key=repr)
