"""The SQL of the registered queries on the smallest tables."""

import glob
import os

import duckdb
import pytest

from inquirylake.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    result = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(result.columns)
    cursor = con.execute(queries.SQL[name])
    named = [d[0] for d in cursor.description]
    assert sorted(named) == columns
    expected = sorted(repr(tuple(r[named.index(c)] for c in columns)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r)) for r in result.select(*columns).collect()) == expected


def test_names():
    assert [n.split("_")[0] for n in queries.QUERIES] and {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
