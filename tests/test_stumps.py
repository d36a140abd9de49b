"""Forests of one split against their SQL, on tables where a split is missing or hard to find."""

from datetime import datetime, timedelta

import __spark_entry__  # noqa: F401
import pytest
from catalog.registry import ORACLES, QUERIES
from check import open_tables, spark_rows, sql_rows


@pytest.fixture
def same_as_sql(spark, tmp_path):
    """Whether a query equals its SQL on events of these daily values; and its rows."""

    def run(name, values):
        start = datetime(2024, 1, 1)
        rows = [
            (i, start + timedelta(days=i, hours=1), i % 7, kind, float(value))
            for kind in ("view", "click")
            for i, value in enumerate(values)
        ]
        schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
        events = spark.createDataFrame(rows, schema).coalesce(1)
        events.toPandas().to_parquet(tmp_path / "events.parquet", coerce_timestamps="us")
        made = spark_rows(QUERIES[name](spark, str(tmp_path)))
        assert made == sql_rows(open_tables(str(tmp_path)), ORACLES[name])
        return made[1]

    return run


def test_equal_lags_have_no_split(same_as_sql):
    assert same_as_sql("forest_forecast_stump", [49.0] * 30) == []


def test_lags_equal_in_training_only(same_as_sql):
    assert same_as_sql("forest_forecast_stump", [49.0] * 27 + [60.0] * 3) == []


def test_a_step_among_many_values(same_as_sql):
    """200 values, and a jump where 32 bins have no split."""
    values = [4.0 * (i * 77 % 200) for i in range(200)]
    after = {v: 1000.0 if v < 4 * 3 else v for v in values}
    assert len(same_as_sql("forest_forecast_stump", [after[v] for v in values])) == 10


def test_feature_that_was_never_zero(same_as_sql):
    made = same_as_sql("underivable_feature", [49.0, 60.0] * 15)
    assert [row[1] for row in made] == [None, None]


def test_feature_that_was_always_zero(same_as_sql):
    made = same_as_sql("underivable_feature", [9.0, 17.0] * 15)
    assert [row[1] for row in made] == [12.0, 12.0]


def test_lag_that_splits_better(same_as_sql):
    values = [44.0, 1000.0] * 15
    values[17] = 40.0
    made = same_as_sql("underivable_feature", values)
    assert [row[1] for row in made] == [40.0, 40.0]
