"""Every registered query against its SQL, and the driver's entry points."""

import pytest

import __spark_entry__ as contract
from gaugewell.checks import registry
from gaugewell.checks.compare import connect, differences


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_query_equals_its_sql(spark, con, sf, key):
    assert differences(spark, con, key, sf) == []


def test_every_query_has_sql():
    assert set(registry.queries()) <= set(contract.oracle_sql())
    assert set(registry.queries()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["dataset_name", "columns"] and len(df.first()["columns"]) == 6
