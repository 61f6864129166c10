"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as contract
from compare import database, differences
from jobtide.plans import catalog, oracle

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert differences(spark, FOLDER, name, connection) == []


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.oracle_sql())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 83
