"""Every registered query against its SQL on the smallest driver tables."""

import pytest

import __spark_entry__ as contract
from querybook.oracles import ORACLES
from querybook.queries import QUERIES
from tests.compare import differences, oracle_connection

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with oracle_connection(FOLDER) as opened:
        yield opened


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys() and ORACLES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    query, sql = contract.queries()[name], contract.oracle_sql()[name]
    assert differences(spark, connection, query, sql, FOLDER) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
