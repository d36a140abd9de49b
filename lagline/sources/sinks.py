"""Writing results."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: how a time in UTC ends.
UTC_OFFSET = "+00:00"

RUN_LOG_SCHEMA = (
    "run_id string, kind string, params map<string,string>, "
    "metrics map<string,double>, logged_at timestamp"
)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def write_json_records(df: DataFrame, path: str, time: str = "datetime") -> str:
    """One JSON record per row, the time as text in UTC and missing values as nulls."""
    text = df.withColumn(time, F.concat(F.col(time).cast("string"), F.lit(UTC_OFFSET)))
    text.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def log_run(
    spark: SparkSession,
    path: str,
    kind: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float | None],
) -> str:
    """Append one run with its parameters and metrics; the new run id."""
    run_id = uuid.uuid4().hex
    row = (
        run_id,
        kind,
        {k: "" if v is None else str(v) for k, v in params.items()},
        {k: None if v is None else float(v) for k, v in metrics.items()},
    )
    columns = RUN_LOG_SCHEMA.rsplit(",", 1)[0]
    (
        spark.createDataFrame([row], columns)
        .withColumn("logged_at", F.current_timestamp())
        .write.mode("append")
        .parquet(path)
    )
    return run_id


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path)
