"""Every registered query of the library against its SQL, row by row, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import oracle
from corpuscle.workload.registry import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


def test_every_query_has_its_sql():
    assert QUERIES and QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert oracle.compare(spark, connection, name, entry.queries()[name], entry.oracle_sql()[name], FOLDER) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["question_id", "prompt"]
