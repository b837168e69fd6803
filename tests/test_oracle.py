"""Every registered query equals its SQL answer, values compared exactly."""

import os

import pytest

import __spark_entry__ as contract
from tests.compare import connect, duck_rows, spark_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ANSWERS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ANSWERS))
def test_matches_sql(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = duck_rows(duck, ANSWERS[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    different = [(a, b) for a, b in zip(rows, expected) if a != b]
    assert not different, different[:3]
    assert rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ANSWERS)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).collect()


def test_entry(spark):
    assert contract.entry(spark).count() > 0
