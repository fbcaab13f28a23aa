"""Every registered query against its SQL on the small tables."""

import os

import pytest
from compare import connect, of_spark, of_sql

from sparkraster.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    columns, got = of_spark(registry.queries()[name](spark, SF))
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert got, "no rows"
        return
    want_columns, want = of_sql(con, sql)
    assert columns == want_columns
    assert got == want


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(registry.queries()) <= set(e.queries())
