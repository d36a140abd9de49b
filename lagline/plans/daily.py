"""The daily sequence: train, forecast, monitor."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from lagline.plans.forecasting import HISTORY_WINDOW, forecast_files
from lagline.plans.models import SeasonalModel, load_model, save_model
from lagline.plans.monitoring import Report, run_monitoring
from lagline.plans.training import Trained, train
from lagline.sources.sinks import log_run
from lagline.sources.tables import (
    default_paths,
    load_predictions,
    load_training,
    load_truth,
    read_tables,
)

# Fixed value: days forecast by the daily sequence.
DAILY_HORIZON = 30


class DailyRun(NamedTuple):
    trained: Trained
    forecast: DataFrame
    report: Report


def train_files(
    spark: SparkSession,
    paths: Sequence[str] | None,
    model: str,
    out: str,
    log: str,
    key: Sequence[str] | None = None,
    folder: str = ".",
    **settings: object,
) -> Trained:
    """Read the daily tables, train, keep the model below ``out`` and log the run.

    Without paths the usual files in ``folder`` are read.
    """
    paths = default_paths(folder, "D") if paths is None else paths
    trained = train(load_training(read_tables(spark, paths)), model, key, **settings)
    save_model(spark, trained.model, out)
    params = {"model": model, **settings}
    if isinstance(trained.model, SeasonalModel):
        params["dropped_components"] = ",".join(trained.model.design.dropped)
    log_run(spark, log, "train", params, trained.metrics.first().asDict())
    return trained


def daily_run(
    spark: SparkSession,
    paths: Sequence[str],
    out: str,
    model: str = "rf",
    freq: str = "D",
    horizon: int = DAILY_HORIZON,
    key: Sequence[str] | None = None,
    history_window: int = HISTORY_WINDOW,
    alignment: str = "reference",
    truth_paths: Sequence[str] | None = None,
    **settings: object,
) -> DailyRun:
    """Train, forecast and monitor; each stage reads what the one before has written.

    Forecasts are compared with the tables they come from, whose times they follow, unless
    ``truth_paths`` names tables that hold the later times.
    """
    log = f"{out}/runs"
    trained = train_files(spark, paths, model, f"{out}/model", log, key, **settings)
    made = forecast_files(
        spark,
        load_model(spark, f"{out}/model"),
        paths,
        f"{out}/predictions",
        log,
        key=key,
        horizon=horizon,
        freq=freq,
        history_window=history_window,
        alignment=alignment,
    )
    report = run_monitoring(
        spark,
        load_truth(read_tables(spark, paths if truth_paths is None else truth_paths), key),
        load_predictions(spark.read.parquet(f"{out}/predictions/forecast")),
        log,
        model,
        key,
    )
    return DailyRun(trained, made, report)
