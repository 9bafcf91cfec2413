"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as registry
from tests.compare import compare, duck


@pytest.fixture(scope="module")
def connection(folder):
    return duck(folder)


@pytest.mark.parametrize("name", sorted(registry.REGISTRY))
def test_matches_sql(spark, connection, folder, name):
    problem = compare(spark, connection, folder, name, registry.queries()[name], registry.oracle_sql().get(name))
    # Reports on a moving window may have nothing to report on the smallest tables.
    assert problem in (None, "equal, but empty")


def test_every_query_has_sql():
    assert set(registry.REGISTRY) <= set(registry.oracle_sql())


def test_entry_returns_one_row_per_customer(spark):
    df = registry.entry(spark)
    assert df.count() == df.select("client_id").distinct().count() > 0
