"""Every catalog query against its SQL, run by DuckDB on the same tables."""

import os

import duckdb
import pytest

from viewtide import catalog, oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = catalog.queries()
ORACLE = oracle.oracle_sql()
TABLES = ("customer", "events")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    yield connection
    connection.close()


def rows(table):
    columns = sorted(table.column_names)
    return sorted(zip(*[table[c].to_pylist() for c in columns]), key=repr)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, duck, name):
    ours = QUERIES[name](spark, SF).toArrow()
    theirs = duck.sql(ORACLE[name]).to_arrow_table()
    assert sorted(ours.column_names) == sorted(theirs.column_names)
    assert rows(ours) == rows(theirs)
