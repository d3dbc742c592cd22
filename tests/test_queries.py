"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from gleanwork import workload
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
# Nothing needs to be left out of SQL so far; a query without SQL must be listed here.
WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(workload.queries()))
def test_query_matches_sql(spark, con, name):
    sql = entry.oracle_sql().get(name)
    assert (sql is None) == (name in WITHOUT_SQL)
    verdict, _ = compare(spark, con, name, entry.queries()[name], sql, SF)
    assert verdict.startswith("ok") and "types" not in verdict, verdict


def test_entry(spark):
    assert entry.entry(spark).count() > 0
