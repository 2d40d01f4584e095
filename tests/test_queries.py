"""Every registered query against its SQL at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry_points
from breathline.queries.oracle import ORACLE
from breathline.queries.registry import QUERIES
from compare import connect, differences

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    _, problem = differences(spark, duck, SF, name)
    assert problem == ""


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.count() > 0
    assert frame.columns[:2] == ["device_id", "sensor_id"]
