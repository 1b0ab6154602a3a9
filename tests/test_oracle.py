"""Every registered query that has SQL gives the same rows in DuckDB."""

import glob
import os

import duckdb
import pytest

from foliomill.plans.all import QUERIES, SQL


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    value = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    found = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in found.collect()]
    assert rows
    if name in SQL:
        got = duck.execute(SQL[name])
        names = [d[0] for d in got.description]
        assert sorted(names) == sorted(found.columns)
        assert canonical(rows, found.columns) == canonical(got.fetchall(), names)
