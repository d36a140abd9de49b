"""Reading and standardising input tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagline.functions.clean import normal_label, standard_rows
from lagline.operators.reshape import union_tables, wide_to_long
from lagline.sources import names
from lagline.sources.columns import hourly_layout, rename_first, search_column, series_key

# File names looked for when no paths are given.
DEFAULT_FILES = {
    "H": ["rsqa_2022.parquet", "rsqa_2023.parquet", "rsqa_2024.parquet"],
    "D": ["iqa_daily_2022_2024.parquet", "iqa_daily_2025_2027.parquet"],
}


def default_paths(folder: str, freq: str) -> list[str]:
    return [f"{folder.rstrip('/')}/{name}" for name in DEFAULT_FILES[freq.upper()]]


def read_tables(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Union by name of the Parquet tables that exist; at least one must."""
    found = [t for t in (_read_if_there(spark, p) for p in paths) if t is not None]
    if not found:
        raise FileNotFoundError(f"none of {list(paths)} exists")
    return union_tables(found)


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def preview(df: DataFrame, rows: int = 3) -> tuple[list[str], DataFrame]:
    """The column names and the first rows of a table."""
    return df.columns, df.limit(rows)


def land_csv(
    spark: SparkSession, csv: str, parquet: str, schema: T.StructType | str
) -> DataFrame:
    """Turn landed CSV files into one Parquet table and return it."""
    spark.read.csv(csv, header=True, schema=schema).write.mode("overwrite").parquet(parquet)
    return spark.read.parquet(parquet)


def load_training(df: DataFrame) -> DataFrame:
    """A daily table for training: exact column names, parsed, complete."""
    df = rename_first(df, names.TRAINING_TIMES, "datetime")
    return standard_rows(rename_first(df, names.TRAINING_VALUES, "value"))


def load_daily(df: DataFrame) -> DataFrame:
    """A daily table to forecast from: column names matched loosely, parsed, complete."""
    time = search_column(df.columns, None, names.FORECAST_DAILY_TIMES, names.TIME_PARTS)
    if time:
        df = df.withColumnRenamed(time, "datetime")
    value = search_column(
        df.columns, None, names.FORECAST_DAILY_VALUES, names.FORECAST_DAILY_VALUE_PARTS
    )
    if value:
        df = df.withColumnRenamed(value, "value")
    return standard_rows(df)


def load_hourly(df: DataFrame, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """An hourly table, wide or long, as long rows with normalised labels.

    ``overrides`` maps ``datetime``, ``station_name``, ``pollutant`` or ``value`` to the
    column to use for it; columns that do not exist are ignored.
    """
    for to, column in (overrides or {}).items():
        if column in df.columns:
            df = df.withColumnRenamed(column, to)
    layout = hourly_layout(df)
    df = df.withColumnRenamed(layout.time, "datetime")
    if layout.station:
        df = df.withColumnRenamed(layout.station, "station_name")
    if layout.measures:
        ids = [c for c in ("datetime", "station_name") if c in df.columns]
        df = wide_to_long(df, ids, layout.measures)
    if "pollutant" in df.columns:
        df = df.withColumn("pollutant", normal_label(F.col("pollutant")))
    return standard_rows(df)


def load_truth(df: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """Observed values only, with their key."""
    df = load_training(df)
    return df.select(*series_key(df.columns, key), "datetime", "value")


def load_predictions(df: DataFrame) -> DataFrame:
    """Forecast rows with ``datetime`` and ``forecast`` whatever they were called."""
    renames = {}
    for column in df.columns:
        lower = column.lower()
        if lower in names.FORECAST_NAMES:
            renames[column] = "forecast"
        elif any(part in lower for part in names.TIME_PARTS):
            renames[column] = "datetime"
    named = [renames.get(c, c) for c in df.columns]
    for wanted in ("datetime", "forecast"):
        if named.count(wanted) != 1:
            raise ValueError(f"need exactly one {wanted} column, got {df.columns}")
    return standard_rows(df.toDF(*named), value="forecast")
