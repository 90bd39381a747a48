"""Every registered query against its SQL, on the smallest tables."""

import pytest

from checks.all_queries import QUERIES
from checks.compare import compare, connect
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, con):
    assert compare(QUERIES[name], spark, con, SMALL) is None
