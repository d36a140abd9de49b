"""Corpus queries that SQL can express, against that SQL."""

import pytest
from check import open_tables, spark_rows, sql_rows
from hard_tables import SMALL

from lagline.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db():
    return open_tables(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == sql_rows(db, ORACLES[name])


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
