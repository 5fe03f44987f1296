"""Every registered query with SQL, against DuckDB on the same files."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, duck, name):
    sql = oracle_sql()[name]
    assert difference(queries()[name](spark, SF_DIR), duck, sql) is None
    assert duck.execute(f"select count(*) from ({sql})").fetchone()[0] > 0


def test_entry(spark):
    assert entry(spark).count() > 0
