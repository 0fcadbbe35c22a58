"""Queries of this package on the smallest data, against their SQL where there is one."""

import os

import pytest

from folioforge.llm import queries
from tests.test_queries import SF, compare

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    compare(spark, queries.QUERIES[name], queries.ORACLES.get(name), SF)
