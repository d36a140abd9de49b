"""Comparing forecasts with what was observed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline.functions.clean import present
from lagline.operators.drift import (
    DRIFT_SHARE,
    METHOD,
    column_drift,
    dataset_drift,
    error_histogram,
    largest_errors,
    median_drift,
)
from lagline.operators.joins import align
from lagline.operators.metrics import mae, regression_quality, rmse
from lagline.operators.series import match_keys
from lagline.operators.splits import HALVES_UPTO, RECENT_ROWS, recent_split
from lagline.session import settle, settle_table
from lagline.sources.columns import series_key
from lagline.sources.sinks import log_run

# Alert limits.
MAE_LIMIT = 15.0
DRIFT_LIMIT = 10.0


@dataclass(frozen=True)
class Report:
    """The alert summary per series key, and what it was made from."""

    key: Sequence[str]
    labelled: DataFrame
    summary: DataFrame
    drift: DataFrame

    def quality(self) -> DataFrame:
        return regression_quality(self.labelled, [*self.key, "slice"])

    def errors(self) -> DataFrame:
        return error_histogram(self.labelled, self.key)

    def largest(self) -> DataFrame:
        return largest_errors(self.labelled, self.key)


def monitor(
    truth: DataFrame,
    forecasts: DataFrame,
    key: Sequence[str] | None = None,
    mae_limit: float = MAE_LIMIT,
    drift_limit: float = DRIFT_LIMIT,
    drift_share: float = DRIFT_SHARE,
    method: str = METHOD,
    recent_rows: int = RECENT_ROWS,
    halves_upto: int = HALVES_UPTO,
) -> Report:
    """Errors, drift of the recent rows against the earlier ones, and the alert.

    The key is the station and pollutant columns that both sides have unless given. A series
    of the forecasts that has no time in common with the truth has no points, no drift and
    no alert; so has the one row without a key.
    """
    shared = [c for c in truth.columns if c in forecasts.columns]
    key = series_key(shared, key)
    pairs = settle_table(align(truth, forecasts, key))  # read several times by the split
    order = ["datetime", "value", "forecast"]
    labelled = settle_table(
        recent_split(pairs, order, key, recent_rows=recent_rows, halves_upto=halves_upto)
    )
    drift = settle(column_drift(labelled, key, method=method))
    summary = alert_summary(labelled, drift, key, mae_limit, drift_limit, drift_share)
    if key:
        wanted = present(forecasts.select(*key).distinct(), key)
        summary = match_keys(wanted, summary, key, "left").withColumns(
            {
                "n_points": F.coalesce("n_points", F.lit(0)),
                "drift_score": F.coalesce("drift_score", F.lit(0.0)),
                "dataset_drift": F.coalesce("dataset_drift", F.lit(False)),
                "alert": F.coalesce("alert", F.lit(False)),
            }
        )
    return Report(key, labelled, summary, drift)


def alert_summary(
    labelled: DataFrame,
    drift: DataFrame,
    key: Sequence[str] = (),
    mae_limit: float = MAE_LIMIT,
    drift_limit: float = DRIFT_LIMIT,
    drift_share: float = DRIFT_SHARE,
) -> DataFrame:
    """MAE, RMSE, median drift, dataset drift and whether any of them raises the alert."""
    y, p = F.col("value"), F.col("forecast")
    errors = labelled.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_points"), mae(y, p).alias("mae"), rmse(y, p).alias("rmse")
    )
    medians = median_drift(labelled, key)
    flags = dataset_drift(drift, key, drift_share)
    if key:
        joined = match_keys(match_keys(errors, medians, key, "left"), flags, key, "left")
    else:
        joined = errors.withColumns(
            {n: F.lit(v) for t in (medians, flags) for n, v in t.first().asDict().items()}
        )
    score = F.coalesce(F.col("drift_score"), F.lit(0.0))
    drifted = F.coalesce(F.col("dataset_drift"), F.lit(False))
    alert = (F.col("mae") > mae_limit) | (score > drift_limit) | drifted
    return joined.select(
        *key,
        "n_points",
        "mae",
        "rmse",
        score.alias("drift_score"),
        drifted.alias("dataset_drift"),
        F.coalesce(alert, F.lit(False)).alias("alert"),
    )


def run_monitoring(
    spark: SparkSession,
    truth: DataFrame,
    forecasts: DataFrame,
    log: str,
    model: str = "rf",
    key: Sequence[str] | None = None,
    mae_limit: float = MAE_LIMIT,
    drift_limit: float = DRIFT_LIMIT,
    method: str = METHOD,
    recent_rows: int = RECENT_ROWS,
    halves_upto: int = HALVES_UPTO,
) -> Report:
    """Monitor and log one run over all series: worst drift, any alert."""
    report = monitor(
        truth, forecasts, key, mae_limit, drift_limit, DRIFT_SHARE, method, recent_rows, halves_upto
    )
    summary = settle(report.summary)
    points = F.col("n_points")
    overall = summary.agg(
        F.sum(points).alias("n_points"),
        (F.sum(F.col("mae") * points) / F.sum(points)).alias("mae"),
        F.sqrt(F.sum(F.col("rmse") * F.col("rmse") * points) / F.sum(points)).alias("rmse"),
        F.max("drift_score").alias("drift_median_abs"),
        F.max(F.col("dataset_drift").cast("double")).alias("drift_dataset_flag"),
        F.max(F.col("alert").cast("double")).alias("alert_flag"),
    ).first().asDict()
    params = {
        "model": model,
        "mae_threshold": mae_limit,
        "drift_threshold": drift_limit,
        "n_points": overall.pop("n_points") or 0,
    }
    if params["n_points"]:
        log_run(spark, log, "monitor", params, overall)
    return replace(report, summary=summary)
