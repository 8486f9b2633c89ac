"""Every query with SQL gives the rows that DuckDB gives."""

import glob
import os

import duckdb
import pytest

from freshet.catalogue import QUERIES, SQL

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def ordered(rows, columns):
    names = sorted(columns)
    picks = [columns.index(n) for n in names]
    return sorted((tuple(r[i] for i in picks) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert ordered(df.collect(), df.columns) == ordered(result.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0
