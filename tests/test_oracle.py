"""Every registered query against its SQL, on the whole small tables."""

import os

import pytest
from compare import compare, connect

from studiolens.plans import catalog, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_each_query_has_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, con, name):
    problem = compare(catalog.queries()[name](spark, SF_DIR), con, oracle.oracle_sql()[name])
    assert problem is None, problem
