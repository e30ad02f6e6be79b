"""Every query against its SQL on the sf0.01 tables."""

import pytest
from compare import check

import __spark_entry__ as entry
from roadlens.plans.oracle import ORACLE
from roadlens.plans.queries import QUERIES


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


def test_entry(spark):
    assert entry.entry(spark).columns == ["area_name", "road_id", "car_count", "monitor_infos", "flow_level"]


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, folder, name):
    assert check(QUERIES[name](spark, folder), con, ORACLE[name]) > 0
