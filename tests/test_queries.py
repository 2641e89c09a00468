"""Every named query beside its SQL on the smallest tables, and the plain contract."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from skywell.plans import analysis_queries, clean_queries, explore_queries, fixtures, forecast_queries, stream_queries
from tests.compare import database, difference

SF = "/root/testdata/sf0.001"
OWN = (analysis_queries, clean_queries, explore_queries, forecast_queries, stream_queries)
QUERIES = {n for n, f in queries().items() if f.__module__ in {m.__name__ for m in OWN}}
SQL = set(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(QUERIES & SQL))
def test_query_equals_sql(spark, con, name):
    assert difference(queries()[name](spark, SF), con, oracle_sql()[name]) is None


# The smallest tables have no hour with all channels, which the forest judges.
NO_ROWS = {"isolation_forest"}


@pytest.mark.parametrize("name", sorted(QUERIES - SQL))
def test_query_without_sql_has_rows(spark, name):
    assert (queries()[name](spark, SF).count() > 0) == (name not in NO_ROWS)


def test_the_forest_marks_its_share_of_complete_hours(spark):
    sf = SF.replace("0.001", "0.01")
    complete = fixtures.hourly(spark, sf).dropna().count()
    marked = queries()["isolation_forest"](spark, sf)
    assert 0 < marked.select("ts").distinct().count() <= complete


def test_entry_has_stable_schema(spark):
    df = entry(spark)
    assert df.columns == ["pattern", "part", "channel", "mean", "n"]
    assert df.count() > 0
    assert set(oracle_sql()) <= set(queries())
