"""Feature tables for hourly and daily series."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline.functions.clean import calendar, present, with_numbers, with_times
from lagline.operators.filters import matching_text, only_pollutant
from lagline.operators.joins import attach_weather
from lagline.operators.series import long_series
from lagline.operators.windows import is_daily, window_features
from lagline.session import settle_table
from lagline.sources import names
from lagline.sources.columns import (
    daily_value_column,
    first_present,
    numeric_columns,
    rename_first,
    with_series_key,
)
from lagline.sources.sinks import write_parquet
from lagline.sources.tables import read_tables

# Lags, rolling lengths and the defaults of the featurise job.
HOURLY_LAGS = (1, 2, 3, 6, 12, 24)
DAILY_LAGS = (1, 2, 3, 7, 14)
HOURLY_ROLL = 24
DAILY_ROLL = 7
DEFAULT_STATION = "SAINT-DENIS"
DEFAULT_POLLUTANT = "NO2"


class FeatureTable(NamedTuple):
    """A table with one row per usable reading, and the names of its feature columns."""

    frame: DataFrame
    features: list[str]


def hourly_features(
    readings: DataFrame,
    weather: DataFrame | None = None,
    pollutant: str | None = None,
    lags: Sequence[int] = HOURLY_LAGS,
    key: Sequence[str] | None = None,
    daily: bool | None = None,
) -> FeatureTable:
    """Lag, rolling, calendar and weather features with the next value as target.

    ``key`` defaults to station and pollutant; an empty key treats the table as one
    series. The rolling length follows the median gap between readings unless
    ``daily`` says which it is. Only complete rows are returned.
    """
    x = rename_first(readings, names.HOURLY_TIMES, "datetime")
    x = rename_first(x, names.HOURLY_VALUES, "value")
    if key is None:
        x, key = with_series_key(x)
    keep = [*key, *(c for c in names.HOURLY_COLUMNS if c not in key)]
    x = x.select(*[c for c in keep if c in x.columns])
    x = with_numbers(with_times(x, ["datetime"]), ["value"])
    x = only_pollutant(present(x, ["datetime", *key]), pollutant)
    x = attach_weather(x, weather)
    longer = long_series(x, key)
    if daily is None:
        if weather is not None:
            x = settle_table(x)  # read for the gaps and again for the features
        daily = is_daily(x, key, longer=longer)
    x = window_features(
        x,
        key,
        ["datetime", "value"],
        lags=lags,
        rolls=[DAILY_ROLL if daily else HOURLY_ROLL],
        target="target",
        longer=longer,
    )
    x = x.withColumns(calendar(F.col("datetime")))
    x = present(x, x.columns)
    not_features = {*names.HOURLY_COLUMNS, *key, "target"}
    return FeatureTable(x, numeric_columns(x.schema, not_features))


def daily_features(
    table: DataFrame,
    lags: Sequence[int] = DAILY_LAGS,
    key: Sequence[str] | None = None,
    strict: bool = False,
) -> FeatureTable:
    """Lag, rolling and calendar features of a daily index with the next value as target.

    Every other numeric column is a feature too. Rows must be complete in the features,
    value and target; ``strict`` asks for all columns to be complete.
    """
    time = first_present(table.columns, names.DAILY_TIMES)
    if time is None:
        raise ValueError(f"no time column among {table.columns}")
    x = table.withColumnRenamed(time, "datetime")
    x = present(with_times(x, ["datetime"]), ["datetime"])
    x = x.withColumnRenamed(daily_value_column(x.schema), "value")
    x = with_numbers(x, ["value"])
    if key is None:
        x, key = with_series_key(x)
    x = window_features(
        present(x, key),
        key,
        ["datetime", "value"],
        lags=lags,
        rolls=[DAILY_ROLL],
        target="target",
    )
    x = x.withColumns(calendar(F.col("datetime"), hour=False))
    features = numeric_columns(x.schema, {"datetime", "value", "target"})
    needed = x.columns if strict else [*features, "value", "target"]
    return FeatureTable(present(x, needed), features)


def featurise_readings(
    readings: DataFrame,
    station: str | None = DEFAULT_STATION,
    pollutant: str | None = DEFAULT_POLLUTANT,
    lags: Sequence[int] = HOURLY_LAGS,
    key: Sequence[str] | None = None,
) -> FeatureTable:
    """Hourly features of one pollutant at the stations whose name matches; without a
    station or pollutant, of all of them."""
    if station and "station_name" in readings.columns:
        readings = matching_text(readings, "station_name", station)
    return hourly_features(readings, pollutant=pollutant, lags=lags, key=key)


def featurise_files(
    spark: SparkSession,
    paths: Sequence[str],
    out: str,
    station: str | None = DEFAULT_STATION,
    pollutant: str | None = DEFAULT_POLLUTANT,
    partition_by: Sequence[str] = (),
) -> FeatureTable:
    """Read the hourly tables, build their features and write them to ``out``."""
    table = featurise_readings(read_tables(spark, paths), station, pollutant)
    write_parquet(table.frame, out, partition_by)
    return FeatureTable(spark.read.parquet(out), table.features)
