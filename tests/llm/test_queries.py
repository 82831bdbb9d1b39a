"""The registered queries of this package: those with SQL against it, all of them on a small folder."""

import pytest

import __spark_entry__ as contract
from basketflow.llm.queries import ORACLES, QUERIES
from tests.compare import differences, oracle_connection

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert QUERIES.keys() <= contract.queries().keys() and ORACLES.items() <= contract.oracle_sql().items()
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline"} == set(range(1, 14))


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    with oracle_connection(FOLDER) as connection:
        assert differences(spark, connection, QUERIES[name], ORACLES[name], FOLDER) is None
