"""Every registered query beside its DuckDB SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from holdfast import catalog
from oracle_check import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


OWN = sorted(catalog.all_queries())


def test_every_own_query_is_registered_with_sql():
    assert set(OWN) <= set(contract.queries()) and set(OWN) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    assert compare(got, duck.execute(contract.oracle_sql()[name]).df()) == ""


def test_entry(spark):
    assert contract.entry(spark).count() == 24
