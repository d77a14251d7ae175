"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from changeflow.queries import QUERIES
from tools.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_the_contract_is_complete():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    outcome = compare(spark, con, name, SF)
    assert outcome.startswith(("ok", "rows only")), outcome


def test_entry(spark):
    result = contract.entry(spark)
    assert [r.matches for r in result.collect()] == [True, True]
