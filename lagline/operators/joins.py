"""Joins on time and series key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from lagline.functions.clean import present, with_times


def attach_weather(readings: DataFrame, weather: DataFrame | None) -> DataFrame:
    """Weather columns by equal time, keeping readings that have none.

    The join stays a left join and comes before any lag: a reading without weather
    still is a neighbour of the readings around it. Spark picks the broadcast by the
    measured size of the weather table.
    """
    if weather is None or "datetime" not in weather.columns or weather.isEmpty():
        return readings
    shared = (set(readings.columns) & set(weather.columns)) - {"datetime"}
    if shared:
        raise ValueError(f"weather repeats columns of the readings: {sorted(shared)}")
    return readings.join(with_times(weather, ["datetime"]), "datetime", "left")


def time_grid(df: DataFrame) -> DataFrame:
    """The distinct times of a table, as a weather table without measures."""
    return df.select("datetime").distinct()


def align(
    truth: DataFrame, forecasts: DataFrame, key: Sequence[str] = (), repeats: bool = False
) -> DataFrame:
    """Observed and forecast values of the same series and time.

    Without a key a time must not occur twice on a side, as with several stations every
    value would meet every forecast; ``repeats`` allows it.
    """
    on = [*key, "datetime"]
    if not key and not repeats:
        for side in (truth, forecasts):
            if not side.groupBy("datetime").count().where("count > 1").isEmpty():
                raise ValueError("times repeat: name the key of the series")
    pairs = truth.select(*on, "value").join(forecasts.select(*on, "forecast"), on, "inner")
    return present(pairs, ["value", "forecast"])
