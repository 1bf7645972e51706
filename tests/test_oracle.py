"""Every named query against its SQL on the smallest tables, to the last digit."""

import pytest
from compare import connect, differences

from shelfcast.plans.catalog import QUERIES, registered
from shelfcast.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, connection, sf_dir, name):
    assert differences(spark, connection, registered()[name], ORACLE[name], sf_dir) == ""
