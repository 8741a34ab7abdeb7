"""Every registered query against its SQL on the driver tables."""

import pytest

import __spark_entry__ as E
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_each_query_has_sql():
    from checks.queries import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_equals_sql(spark, con, sf_dir, name):
    rows, extra, missing = differences(spark, con, E.queries()[name], E.oracle_sql()[name], sf_dir)
    assert rows > 0
    assert not extra and not missing, (extra, missing)
