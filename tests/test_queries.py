"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from compare import connect, differences
from conftest import TESTDATA

import __spark_entry__ as entry

FOLDER = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) == []


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == spark.read.parquet(f"{FOLDER}/orders.parquet").count()
