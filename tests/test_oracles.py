"""Every registered query against its SQL, over the smallest test tables."""

import os

import pytest

import __spark_entry__ as contract
from checks import queries as registered
from checks.compare import connect, difference
from checks.oracles import oracle_sql as registered_sql

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registered.queries()) == set(registered_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_same_as_sql(spark, connection, name):
    report, rows, _ = difference(spark, connection, name, SF_DIR)
    assert not report and rows > 0


def test_entry(spark):
    assert contract.entry(spark).columns[:3] == ["msisdn", "loan_id", "loan_ts"]
