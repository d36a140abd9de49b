"""Multi-step forecasts of many series at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline.functions.clean import (
    STD_FLOOR,
    calendar,
    from_zscore,
    present,
    quoted,
    standard_rows,
    step_interval,
    zscore,
)
from lagline.functions.history import back, mean_before_newest, push, recur, weighted_sum
from lagline.operators.filters import (
    history_tail,
    matching_text,
    only_normal_pollutant,
)
from lagline.operators.metrics import forecast_summary
from lagline.plans.models import (
    ForestModel,
    Model,
    SeasonalModel,
    SequenceModel,
    model_kind,
)
from lagline.plans.state import state_rows, update_state
from lagline.session import settle
from lagline.sources import names
from lagline.sources.columns import lags_in, name_history_columns, search_column, series_key
from lagline.sources.sinks import log_run, write_json_records, write_parquet
from lagline.sources.tables import default_paths, load_daily, load_hourly, read_tables

# Rolling features a forest may use, default horizon and history.
ROLLS = {"roll_7": 7, "roll_24": 24}
HORIZON = 7
HISTORY_WINDOW = 30

# Steps of the forest forecast between two cuts of the plan.
SETTLE_EVERY = 5


class Forecast(NamedTuple):
    """Forecast rows, and the series whose history was too short for one."""

    rows: DataFrame
    short: DataFrame


def history_arrays(history: DataFrame, key: Sequence[str], keep: int) -> DataFrame:
    """One row per series: its last ``keep`` values, oldest first, and its last time.

    Only ``keep`` rows of a series are ever gathered.
    """
    tail = history_tail(history, key, keep, ["datetime", "value"])
    ordered = F.array_sort(F.collect_list(F.struct("datetime", "value")))
    return tail.groupBy(*key).agg(
        F.transform(ordered, lambda r: r["value"]).alias("__history"),
        F.max("datetime").alias("__last"),
    )


def ready_histories(
    history: DataFrame, key: Sequence[str], need: int
) -> tuple[DataFrame, DataFrame]:
    """(histories of ``need`` values, the series that have fewer and how many)."""
    arrays = settle(history_arrays(history, key, need))
    size = F.size("__history")
    short = arrays.where(size < need).select(*key, size.cast("bigint").alias("history_rows"))
    return arrays.where(size >= need), short


def spread_forecasts(rows: DataFrame, key: Sequence[str], values: Column, freq: str) -> DataFrame:
    """Turn an array of forecasts per series into rows with their times."""
    steps = rows.select(*key, "__last", F.posexplode(values).alias("__step", "forecast"))
    time = F.col("__last") + step_interval(freq, F.col("__step") + 1)
    return steps.select(*key, time.alias("datetime"), "forecast")


def future_times(history: DataFrame, key: Sequence[str], horizon: int, freq: str) -> DataFrame:
    """The next ``horizon`` times after each series' last one."""
    last = present(history.groupBy(*key).agg(F.max("datetime").alias("__last")), ["__last"])
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("__step")
    time = F.col("__last") + step_interval(freq, F.col("__step"))
    return last.select(*key, "__last", step).select(*key, time.alias("datetime"))


def forest_inputs(
    features: Sequence[str],
    history: Column,
    last: Column,
    following: Column,
    alignment: str,
) -> dict[str, Column]:
    """The feature values for the next step of a forest forecast.

    ``reference`` pairs the newest value as ``lag_1`` with the calendar of the step to
    be forecast. ``consistent`` repeats what the forest saw in training: lags counted
    from the last observed row, and that row's calendar. A feature that cannot be
    derived is 0.
    """
    shift = 0 if alignment == "reference" else 1
    known = {f"lag_{n}": back(history, n + shift) for n in lags_in(features)}
    known |= {r: mean_before_newest(history, n) for r, n in ROLLS.items() if r in features}
    known |= calendar(following if alignment == "reference" else last)
    return {f: known.get(f, F.lit(0.0)).cast("double") for f in features}


def history_needed(features: Sequence[str], alignment: str) -> int:
    """Rows of history a forest with these features needs."""
    lags = lags_in(features)
    if not lags:
        raise ValueError("the model has no lag features and cannot forecast")
    if alignment == "reference":
        return max(lags)
    if alignment == "consistent":
        rolls = [n for name, n in ROLLS.items() if name in features]
        return max(lags + rolls) + 1
    raise ValueError(f"alignment must be reference or consistent, got {alignment!r}")


def forecast_forest(
    model: ForestModel,
    history: DataFrame,
    key: Sequence[str] = (),
    horizon: int = HORIZON,
    freq: str = "D",
    alignment: str = "reference",
) -> Forecast:
    """Step all series forward together, feeding each prediction back as a lag."""
    need = history_needed(model.features, alignment)
    state, short = ready_histories(history, key, need)
    state = state.withColumn("__made", F.array().cast("array<double>"))
    assembler = VectorAssembler(inputCols=[*map(quoted, model.features)], outputCol="__x")
    fitted = model.model.copy()
    fitted.setFeaturesCol("__x").setPredictionCol("__y")
    past, made, y = F.col("__history"), F.col("__made"), F.col("__y")
    last = F.col("__last") + step_interval(freq, F.size(made))
    following = F.col("__last") + step_interval(freq, F.size(made) + 1)
    inputs = forest_inputs(model.features, past, last, following, alignment)
    for done in range(1, horizon + 1):
        stepped = fitted.transform(assembler.transform(state.withColumns(inputs)))
        state = stepped.select(
            *key,
            "__last",
            push(past, y, need).alias("__history"),
            F.concat(made, F.array(y)).alias("__made"),
        )
        if done % SETTLE_EVERY == 0 or done == horizon:
            state = settle(state)
    return Forecast(spread_forecasts(state, key, made, freq), short)


def forecast_seasonal(
    model: SeasonalModel,
    history: DataFrame,
    key: Sequence[str] = (),
    horizon: int = HORIZON,
    freq: str = "D",
) -> Forecast:
    """Evaluate the seasonal model at the next times; nothing is fed back."""
    times = model.scaling.attach(future_times(history, key, horizon, freq))
    predicted = weighted_sum(model.design.columns(F.col("datetime")), model.weights)
    value = from_zscore(predicted + F.lit(model.intercept), F.col("mean"), F.col("std"))
    short = history.limit(0).select(*key, F.lit(0).cast("bigint").alias("history_rows"))
    return Forecast(times.select(*key, "datetime", value.alias("forecast")), short)


def forecast_sequence(
    model: SequenceModel,
    history: DataFrame,
    key: Sequence[str] = (),
    horizon: int = HORIZON,
    freq: str = "D",
) -> Forecast:
    """Recurse on the standardised values, the whole horizon in one projection."""
    state, short = ready_histories(history, key, model.seq_len)
    state = model.scaling.attach(state)
    mean, std = F.col("mean"), F.col("std")
    scaled = F.transform("__history", lambda v: zscore(v, mean, std + F.lit(STD_FLOOR)))
    ahead = recur(scaled, model.weights, model.intercept, horizon)
    values = F.transform(ahead, lambda z: from_zscore(z, mean, std))
    return Forecast(spread_forecasts(state, key, values, freq), short)


def forecast(
    model: Model,
    history: DataFrame,
    key: Sequence[str] | None = None,
    horizon: int = HORIZON,
    freq: str = "D",
    **settings: object,
) -> Forecast:
    """Forecast with whatever kind of model is given; the key is the station and pollutant
    columns unless given."""
    key = series_key(history.columns, key)
    run = {
        ForestModel: forecast_forest,
        SeasonalModel: forecast_seasonal,
        SequenceModel: forecast_sequence,
    }[type(model)]
    return run(model, history, key, horizon, freq, **settings)


def rows_of_history(model: Model, history_window: int, alignment: str = "reference") -> int:
    """The rows of each series to keep: ``history_window``, or more if the model needs more."""
    if isinstance(model, ForestModel):
        return max(history_window, history_needed(model.features, alignment))
    if isinstance(model, SequenceModel):
        return max(history_window, model.seq_len)
    return history_window


def choose_history(
    table: DataFrame,
    model: Model,
    key: Sequence[str] | None = None,
    freq: str = "D",
    history_window: int = HISTORY_WINDOW,
    station: str | None = None,
    pollutant: str | None = None,
    columns: Mapping[str, str] | None = None,
    alignment: str = "reference",
) -> DataFrame:
    """Filter a loaded table and keep the newest rows of each series.

    These are ``history_window`` rows, or more if the model and the alignment need more. The
    key is the station and pollutant columns unless given.
    """
    given = columns or {}
    if station:
        at = search_column(
            table.columns,
            given.get("station_name"),
            names.FORECAST_STATIONS,
            names.STATION_PARTS,
        )
        table = matching_text(table, at, station) if at else table
    if freq.upper() == "H" and pollutant:
        table = only_normal_pollutant(table, pollutant)
    table = name_history_columns(table, given.get("datetime"), given.get("value"))
    key = series_key(table.columns, key)
    rows = rows_of_history(model, history_window, alignment)
    columns_kept = table.select(*key, "datetime", "value")
    tail = history_tail(columns_kept, key, rows, ["datetime", "value"])
    return standard_rows(tail)


def forecast_files(
    spark: SparkSession,
    model: Model,
    paths: Sequence[str] | None,
    out: str,
    log: str,
    key: Sequence[str] | None = None,
    horizon: int = HORIZON,
    freq: str = "D",
    history_window: int = HISTORY_WINDOW,
    station: str | None = None,
    pollutant: str | None = None,
    columns: Mapping[str, str] | None = None,
    alignment: str = "reference",
    folder: str = ".",
    state: str | None = None,
) -> DataFrame:
    """Read, choose the history, forecast, write Parquet and JSON, log the run.

    Without paths the usual files in ``folder`` are read. ``alignment`` is for forests.
    With ``state``, a path where the newest values of every series are kept between runs (see
    ``lagline.plans.state``), ``paths`` names only the files that have come since.
    """
    paths = default_paths(folder, freq) if paths is None else paths
    table = read_tables(spark, paths)
    table = load_hourly(table, columns) if freq.upper() == "H" else load_daily(table)
    history = settle(
        choose_history(
            table, model, key, freq, history_window, station, pollutant, columns, alignment
        )
    )
    key = series_key(history.columns, key)
    if state is not None:
        keep = rows_of_history(model, history_window, alignment)
        history = state_rows(update_state(spark, state, history, key, keep), key)
    settings = {"alignment": alignment} if isinstance(model, ForestModel) else {}
    made = forecast(model, history, key, horizon, freq, **settings)
    if not made.short.isEmpty():
        write_parquet(made.short, f"{out}/too_short")
    write_parquet(made.rows, f"{out}/forecast")
    rows = spark.read.parquet(f"{out}/forecast")
    if rows.isEmpty():
        raise ValueError("no series has enough history to forecast from")
    write_json_records(rows, f"{out}/forecast_json")
    params = {
        "model": model_kind(model),
        "horizon": horizon,
        "freq": freq,
        "history_window": history_window,
        "history_used": history.count(),
        "station_filter": station,
        "pollutant": pollutant,
        "input_paths": ",".join(paths),
    }
    if isinstance(model, SeasonalModel):
        params["dropped_components"] = ",".join(model.design.dropped)
    log_run(spark, log, "forecast", params, forecast_summary(rows).first().asDict())
    return rows
