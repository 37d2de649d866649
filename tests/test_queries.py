from __future__ import annotations

import pytest

import __spark_entry__ as contract
from swipeline.plans.catalog import all_queries
from swipeline.plans.oracle import ORACLES
from check_queries import compare, oracle_connection
from conftest import SF


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(ORACLES)
    assert all_queries().items() <= contract.queries().items()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_its_oracle(spark, connection, name):
    assert compare(spark, connection, all_queries()[name], ORACLES[name], SF) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 1000
