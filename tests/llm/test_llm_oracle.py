"""The queries that SQL can express, against it on the sf0.01 tables."""

import pytest
from compare import check

from roadlens.llm.oracle import ORACLE
from roadlens.llm.queries import QUERIES


@pytest.mark.parametrize("name", ORACLE)
def test_query(spark, con, folder, name):
    assert check(QUERIES[name](spark, folder), con, ORACLE[name]) > 0
