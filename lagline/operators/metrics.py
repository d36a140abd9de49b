"""Error metrics and summaries, overall or per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.functions.clean import STD_FLOOR


def mae(value: Column, forecast: Column) -> Column:
    return F.avg(F.abs(value - forecast))


def rmse(value: Column, forecast: Column) -> Column:
    return F.sqrt(F.avg((value - forecast) * (value - forecast)))


def regression_metrics(
    pairs: DataFrame,
    key: Sequence[str] = (),
    value: str = "value",
    forecast: str = "forecast",
) -> DataFrame:
    """MAE and RMSE; one row, or one row per key."""
    y, p = F.col(value), F.col(forecast)
    return pairs.groupBy(*key).agg(mae(y, p).alias("mae"), rmse(y, p).alias("rmse"))


def slice_metrics(
    scored: DataFrame, value: str = "target", forecast: str = "forecast"
) -> DataFrame:
    """One row with MAE and RMSE of the train and the validation slice."""

    def within(label: str) -> tuple[Column, Column]:
        chosen = F.col("slice") == label
        return F.when(chosen, F.col(value)), F.when(chosen, F.col(forecast))

    train, validation = within("train"), within("validation")
    return scored.agg(
        mae(*train).alias("mae_tr"),
        rmse(*train).alias("rmse_tr"),
        mae(*validation).alias("mae_va"),
        rmse(*validation).alias("rmse_va"),
    )


def forecast_summary(forecasts: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Mean, population standard deviation, least and greatest forecast."""
    return forecasts.groupBy(*key).agg(
        F.avg("forecast").alias("forecast_mean"),
        F.stddev_pop("forecast").alias("forecast_std"),
        F.min("forecast").alias("forecast_min"),
        F.max("forecast").alias("forecast_max"),
    )


def scaler(df: DataFrame, key: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Mean and population standard deviation, the latter kept above zero."""
    return df.groupBy(*key).agg(
        F.avg(value).alias("mean"), (F.stddev_pop(value) + STD_FLOOR).alias("std")
    )


def regression_quality(pairs: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Error statistics per key; pass ``slice`` among the keys to compare slices.

    The error is forecast minus value. The percentage error leaves out zero values.
    Spreads are sample standard deviations.
    """
    error = F.col("forecast") - F.col("value")
    size = F.abs(error)
    percent = F.try_divide(size, F.abs(F.col("value"))) * 100
    squares = F.sum(error * error)
    return pairs.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.avg(error).alias("mean_error"),
        F.stddev_samp(error).alias("error_std"),
        F.avg(size).alias("mae"),
        F.stddev_samp(size).alias("abs_error_std"),
        F.avg(percent).alias("mape"),
        F.stddev_samp(percent).alias("abs_perc_error_std"),
        F.max(size).alias("max_abs_error"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (
            F.lit(1.0)
            - F.try_divide(squares, F.var_pop("value") * F.count(F.lit(1)))
        ).alias("r2"),
    )
