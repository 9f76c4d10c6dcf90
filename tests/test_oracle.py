"""Every registered query against its SQL on the small data set."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, KINDS, rows_of

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in cur.description}
    assert dict(df.dtypes) == kinds
    assert rows_of(got, df.columns) == rows_of(cur.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_oracle_gives_rows(spark, name):
    assert entry.queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
