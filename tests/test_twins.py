"""Every query equals its SQL twin on the smallest test data."""

import pytest
from compare import connect, difference

from cliniform.checks import queries, sql_twins

FOLDER = "/root/testdata/sf0.001"
TWINS = sql_twins()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_twin(spark, con, name):
    assert difference(queries()[name](spark, FOLDER), con, TWINS[name]) is None


def test_every_query_has_a_twin():
    assert set(queries()) == set(TWINS)
