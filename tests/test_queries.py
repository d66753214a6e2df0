"""Every registered query against its SQL on an independent engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from verification.compare import connect, difference
from verification.oracle import ORACLE
from verification.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "diesel_usd_gal" in df.columns


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert difference(spark, connection, name, FOLDER) is None
