"""Every registered query against its SQL check, on the smallest data."""

import pytest

from check import compare, connect
from ledgerloom.catalog import CHECKS, QUERIES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_check(spark, con, name):
    ok, _, note = compare(spark, con, name, QUERIES[name], CHECKS.get(name), SMALL)
    assert ok, note


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
