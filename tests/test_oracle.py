"""Every registered query against its SQL, on the smallest tables."""

import pytest

from crewcast.catalog import ORACLES, QUERIES
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) == "ok"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
