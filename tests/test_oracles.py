"""Each registered query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from inquirylake import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        out.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return out


def shown(rows):
    return sorted(repr(tuple(r)) for r in rows)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_matches_sql(spark, con, name):
    result = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(result.columns)
    cursor = con.execute(queries.SQL[name])
    named = [d[0] for d in cursor.description]
    assert sorted(named) == columns
    expected = [tuple(r[named.index(c)] for c in columns) for r in cursor.fetchall()]
    got = result.select(*columns).collect()
    assert shown(got) == shown(expected)
    assert expected, "the query should have rows to compare"


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(queries.SQL)
