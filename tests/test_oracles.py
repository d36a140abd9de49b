"""Every query against its SQL on the smallest tables."""

import __spark_entry__ as entry_module
import pytest
from catalog.registry import ORACLES, QUERIES
from check import open_tables, spark_rows, sql_rows
from conftest import SMALL


#: Queries whose tables never reach code that splits long series, or that train forests.
NO_SERIES = {
    name
    for name in ORACLES
    if name.startswith(("forest", "batch", "daily_run", "daily_backtest", "json", "csv"))
}


@pytest.fixture(scope="module")
def db():
    return open_tables(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == sql_rows(db, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(ORACLES) - NO_SERIES))
def test_long_series_give_the_same(spark, db, tiny_tasks, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == sql_rows(db, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).columns[:3] == ["pollutant", "datetime", "value"]


def test_oracles_are_queries():
    assert set(ORACLES) <= set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
