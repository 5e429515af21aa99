import re

import duckdb
import pytest

import __spark_entry__ as contract
from tools.compare import TABLES, rows_of

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(result.columns)
    assert got == rows_of(result.columns, result.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert all(re.fullmatch(r"(ml_\w+|stream_predictions|op\d+_\w+|pipeline)", n) for n in set(QUERIES) - set(ORACLES))


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["offset", "term", "tf"] and df.limit(1).count() == 1
