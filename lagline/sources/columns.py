"""Finding the time, station and value columns of a table by name.

Everything here reads ``df.schema`` only, except :func:`measure_counts`, which takes one
aggregate pass over the data.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagline.functions.clean import parse_number, quoted
from lagline.sources import names


def first_present(columns: Sequence[str], wanted: Iterable[str]) -> str | None:
    return next((w for w in wanted if w in columns), None)


def rename_first(df: DataFrame, wanted: Iterable[str], to: str) -> DataFrame:
    """Rename the first of ``wanted`` that exists, unless ``to`` exists already."""
    found = None if to in df.columns else first_present(df.columns, wanted)
    return df.withColumnRenamed(found, to) if found else df


def search_column(
    columns: Sequence[str],
    preferred: str | None,
    aliases: Iterable[str],
    parts: Iterable[str] = (),
) -> str | None:
    """The preferred name, else the first alias in any case, else the first column
    containing one of ``parts``."""
    if preferred and preferred in columns:
        return preferred
    by_lower = {c.lower(): c for c in columns}
    alias = first_present(list(by_lower), (a.lower() for a in aliases))
    if alias:
        return by_lower[alias]
    parts = list(parts)
    return next((c for c in columns if any(p in c.lower() for p in parts)), None)


def numeric_columns(schema: T.StructType, leave_out: Iterable[str] = ()) -> list[str]:
    skip = set(leave_out)
    return [
        f.name
        for f in schema
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in skip
    ]


def daily_value_column(schema: T.StructType) -> str:
    """A known value name, else the only index-like name, else the first number."""
    columns = schema.names
    known = first_present(columns, names.DAILY_VALUES)
    if known:
        return known
    alike = [c for c in columns if re.search(names.DAILY_VALUE_PATTERN, c, re.IGNORECASE)]
    if len(alike) == 1:
        return alike[0]
    numbers = numeric_columns(schema)
    if numbers:
        return numbers[0]
    raise ValueError(f"no value column among {columns}")


def with_series_key(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The table and its key: the station column and, if present, the pollutant.

    A table without a station column gets a constant series id.
    """
    station = first_present(df.columns, names.STATION_KEYS)
    if station is None:
        station, value = names.SINGLE_SERIES
        df = df.withColumn(station, F.lit(value))
    return df, [station, *(["pollutant"] if "pollutant" in df.columns else [])]


def series_key(columns: Sequence[str], key: Sequence[str] | None) -> list[str]:
    """The given key, or the station and pollutant columns that there are; an empty key
    treats a table as one series."""
    if key is not None:
        return list(key)
    station = first_present(columns, names.STATION_KEYS)
    return [*([station] if station else []), *(["pollutant"] if "pollutant" in columns else [])]


def lags_in(features: Iterable[str]) -> list[int]:
    """The n of every ``lag_n`` among the feature names."""
    found = (re.fullmatch(r"lag_(\d+)", name) for name in features)
    return sorted({int(m.group(1)) for m in found if m})


class Layout(NamedTuple):
    time: str
    station: str | None
    measures: list[str]


def measure_candidates(df: DataFrame, leave_out: Iterable[str]) -> list[str]:
    skip = set(leave_out)
    return [
        c for c in df.columns if c not in skip and c.lower() not in names.NEVER_MEASURES
    ]


def measure_counts(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """One row: how many cells of each candidate column are numbers."""
    return df.agg(
        *[
            F.count(parse_number(F.col(quoted(c)), df.schema[c].dataType)).alias(c)
            for c in candidates
        ]
    )


def hourly_layout(df: DataFrame) -> Layout:
    """Where an hourly table keeps time, station and measures.

    A table with a ``value`` column is long and has no measure columns. Otherwise every
    column with at least one number is a measure.
    """
    time = search_column(df.columns, None, names.FORECAST_HOURLY_TIMES, names.TIME_PARTS)
    station = search_column(df.columns, None, names.FORECAST_STATIONS, names.STATION_PARTS)
    if time is None:
        raise ValueError(f"no time column among {df.columns}")
    if "value" in df.columns:
        return Layout(time, station, [])
    candidates = measure_candidates(df, [time, station])
    filled = measure_counts(df, candidates).first().asDict() if candidates else {}
    measures = [c for c in candidates if filled[c] > 0]
    if not measures:
        raise ValueError(f"no measure column among {df.columns}")
    return Layout(time, station, measures)


def name_history_columns(
    df: DataFrame, time: str | None = None, value: str | None = None
) -> DataFrame:
    """Name the time and value columns of a table to forecast from."""
    found = search_column(df.columns, time, names.FORECAST_HOURLY_TIMES, names.TIME_PARTS)
    if found is None:
        raise ValueError(f"no time column among {df.columns}")
    df = df.withColumnRenamed(found, "datetime")
    if "value" in df.columns:
        return df
    found = search_column(
        df.columns, value, names.FORECAST_HOURLY_VALUES, names.FORECAST_HOURLY_VALUE_PARTS
    )
    if found is None:
        raise ValueError(f"no value column among {df.columns}")
    return df.withColumnRenamed(found, "value")


def scoring_columns(df: DataFrame, saved: Sequence[str] | None) -> list[str]:
    """The saved feature list if the rows have all of it, else every usable number."""
    if saved and all(c in df.columns for c in saved):
        return list(saved)
    return numeric_columns(df.schema, names.NEVER_FEATURES)
