"""The queries that SQL can express against their SQL."""

import pytest

from kinetable.llm.queries import ORACLES, QUERIES
from tests.harness import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, name):
    assert compare(spark, connect(sf), sf, name, QUERIES[name], ORACLES[name]) == ""
