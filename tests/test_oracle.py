"""Every registered query against its SQL, all rows."""

import pytest

from checks.compare import compare, connect
from checks.oracle import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, small, con, name):
    assert compare(QUERIES[name](spark, small), con, ORACLES[name]) == ""
