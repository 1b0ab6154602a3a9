"""Queries of the subpackage that have SQL give the same rows in DuckDB; all give a row for each document or conversation."""

import glob
import os

import duckdb
import pytest

from foliomill.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    found = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in found.collect()]
    if name not in SQL:
        assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
        return
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    got = con.execute(SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(found.columns)
    order = [names.index(c) for c in found.columns]
    assert sorted(rows, key=repr) == sorted((tuple(r[i] for i in order) for r in got.fetchall()), key=repr)
