import pytest

import __spark_entry__ as entry
from tickflow.plans import catalog, jobs  # noqa: F401

from .compare import compare, connect
from .conftest import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    spark_rows, duck_rows, differences = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert not differences
    assert spark_rows == duck_rows


def test_every_log_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
