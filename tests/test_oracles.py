"""Every registered query against its SQL on the smallest tables."""

import pytest

from kinetable.plans import ORACLES, QUERIES, load_all
from tests.harness import compare, connect

load_all()


@pytest.fixture(scope="module")
def con():
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf, name):
    diff = compare(spark, con, sf, name, QUERIES[name], ORACLES[name])
    assert diff == "", diff
