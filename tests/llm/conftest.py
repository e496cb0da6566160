import os

import duckdb
import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels"):
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    yield connection
    connection.close()


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text, source) as a table with columns that operators use inside."""

    def make(rows):
        return spark.createDataFrame(
            [(*row, "x", 1, 2) for row in rows],
            "doc_id long, text string, source string, digest string, size int, rank int",
        )

    return make
