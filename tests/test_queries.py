"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(entry_points.queries()))
def test_query(spark, con, name):
    assert difference(spark, con, name, SF) is None


def test_every_sql_has_its_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_flagship(spark):
    rows = entry_points.entry(spark).collect()
    assert 0 < len(rows) <= 50
