"""Every query that SQL can express against DuckDB."""

import pytest

from viewtide.llm import oracle, queries

QUERIES, ORACLE = queries.queries(), oracle.oracle_sql()


def rows(table):
    columns = sorted(table.column_names)
    return sorted(zip(*[table[c].to_pylist() for c in columns]), key=repr)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_oracle(spark, duck, sf, name):
    ours, theirs = QUERIES[name](spark, sf).toArrow(), duck.sql(ORACLE[name]).to_arrow_table()
    assert sorted(ours.column_names) == sorted(theirs.column_names)
    assert rows(ours) == rows(theirs)
