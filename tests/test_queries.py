"""Every registered query of the retail layers against its SQL; tests/llm has the others."""

import pytest

import __spark_entry__ as contract
from compare import connect, difference
from tallyhouse.plans.oracle import all_oracles
from tallyhouse.plans.queries import all_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(contract.queries()) and set(all_oracles()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_sql(spark, duck, name):
    found = all_queries()[name](spark, SF)
    assert difference(found, duck, all_oracles()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 12
