"""Every registered query against its DuckDB twin."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from suite import ORACLES as OWN_ORACLES, QUERIES as OWN_QUERIES
from suite.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(OWN_QUERIES) == set(OWN_ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    assert differences(queries()[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
