import duckdb
import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A DataFrame from rows and a DDL schema."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)
    return make


@pytest.fixture(scope="session")
def con():
    return duckdb.connect()
