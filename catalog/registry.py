"""The list of queries, and the base tables they share.

Each base table is given twice: as a DataFrame function and as a SQL table expression.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline.functions.clean import present
from lagline.operators.windows import window_features

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must agree with it."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, columns: Iterable[str], places: int = 6) -> DataFrame:
    """Round doubles so that the order of a sum does not show."""
    return df.withColumns({c: F.round(c, places) for c in columns})


def as_bigint(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Events as irregular readings of one value per pollutant and station."""
    return table(spark, folder, "events").select(
        F.col("ts").alias("datetime"),
        F.col("user_id").alias("station_id"),
        F.col("event_type").alias("pollutant"),
        "value",
    )


READINGS = """readings AS (
  SELECT ts AS datetime, user_id AS station_id, event_type AS pollutant, value
  FROM events)"""


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Peak reading per pollutant and hour; hours without a reading are absent."""
    hour = F.date_trunc("hour", "datetime").cast("timestamp_ntz").alias("datetime")
    peak = F.max("value").alias("value")
    return readings(spark, folder).groupBy("pollutant", hour).agg(peak)


HOURLY = """hourly AS (
  SELECT event_type AS pollutant, date_trunc('hour', ts) AS datetime,
         max(value) AS value
  FROM events GROUP BY 1, 2)"""


def daily(spark: SparkSession, folder: str) -> DataFrame:
    """Readings averaged per pollutant and day."""
    day = F.col("datetime").cast("date").cast("timestamp_ntz").alias("datetime")
    return readings(spark, folder).groupBy("pollutant", day).agg(F.avg("value").alias("value"))


DAILY = """daily AS (
  SELECT event_type AS pollutant, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS datetime,
         avg(value) AS value
  FROM events GROUP BY 1, 2)"""


def naive_forecast(rows: DataFrame) -> DataFrame:
    """The previous value of the same pollutant as the forecast of the next."""
    lagged = window_features(rows, ["pollutant"], ["datetime"], lags=[1])
    return present(lagged.withColumnRenamed("lag_1", "forecast"), ["forecast"])


def naive(source: str) -> str:
    return f"""pairs AS (
  SELECT * FROM (
    SELECT *, lag(value) OVER (PARTITION BY pollutant ORDER BY datetime) AS forecast
    FROM {source}) WHERE forecast IS NOT NULL)"""


# The recent rows of each pollutant against the earlier ones.
LABELLED = """labelled AS (
  SELECT *, CASE WHEN pos <= CASE WHEN n <= 60 THEN n // 2 ELSE n - 30 END
            THEN 'reference' ELSE 'current' END AS slice
  FROM (SELECT *,
          row_number() OVER (PARTITION BY pollutant ORDER BY datetime, value, forecast) AS pos,
          count(*) OVER (PARTITION BY pollutant) AS n
        FROM pairs))"""
