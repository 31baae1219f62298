"""Registered queries of the subpackage against their SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import oracle
from corpuscle.llm.registry import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert QUERIES.keys() | {"pipeline"} <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, connection, name):
    assert oracle.compare(spark, connection, name, entry.queries()[name], entry.oracle_sql()[name], FOLDER) == ""
