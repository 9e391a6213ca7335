"""Every registered query against its SQL, on the smallest given tables."""

import os

import pytest

from checks import compare, oracles, queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(queries.all_queries()) == set(oracles.all_queries())


@pytest.mark.parametrize("name", list(queries.all_queries()))
def test_query_equals_its_sql(spark, connection, name):
    assert compare.difference(spark, connection, SF_DIR, name) is None


def test_entry(spark):
    import __spark_entry__ as entry_points

    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.queries()) >= set(entry_points.oracle_sql())
