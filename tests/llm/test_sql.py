"""Registered queries that SQL can express, against their SQL."""

import os

import pytest
from compare import compare, connect

from studiolens.llm import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, name):
    problem = compare(catalog.queries()[name](spark, SF_DIR), connect(SF_DIR), catalog.oracle_sql()[name])
    assert problem is None, problem


def test_numbered_queries():
    numbers = sorted(int(name[2:].split("_")[0]) for name in catalog.queries())
    assert numbers == list(range(1, 14))
