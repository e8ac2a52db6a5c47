"""Every registered query beside its SQL, on the smallest tables."""

import __spark_entry__ as entry
import pytest
from lotledger.plans import registry
from oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql().get(name)) is None


def test_every_query_has_sql():
    assert set(registry.SQL) == set(registry.QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
