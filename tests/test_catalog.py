"""Every query with an SQL twin equals it on the smallest test tables."""

import os

import pytest

import oracle
import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
from homeledger.catalog import ORACLES, QUERIES as OWN  # noqa: E402

QUERIES = contract.queries()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_names():
    assert set(OWN) == set(ORACLES) <= set(contract.oracle_sql()) and set(OWN) <= set(QUERIES) and len(OWN) > 150


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["month", "source", "rows"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None
