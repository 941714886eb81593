"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as catalog
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


#: Queries of the optional operators have tests of their own.
OWN = sorted(name for name in catalog.queries() if not name.startswith("op") and name != "pipeline")


def test_every_query_has_sql():
    assert set(OWN) <= set(catalog.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    problem, _ = compare(spark, con, SF, name, catalog.queries()[name], catalog.oracle_sql()[name])
    assert not problem


def test_entry(spark):
    assert catalog.entry(spark).count() > 0
