"""Least squares with weights of its own for every series, and backtests over many cuts.

The sums of products that least squares need (the Gram matrix) add up over rows, so they are
one aggregate per key with map-side combine, and each series is then solved inside one
projection, millions of them at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagline.functions.clean import present, step_interval
from lagline.operators.metrics import mae, rmse
from lagline.operators.series import match_keys
from lagline.operators.windows import window_features
from lagline.session import settle_table

#: Most inputs: the aggregate has about half their square of sums.
MOST_INPUTS = 30
#: Singular values below this share of the largest count as none.
SMALL = 1e-10


def gram_sums(inputs: Sequence[Column], label: Column) -> dict[str, Column]:
    """The sums over rows of all products of the inputs, the label and 1, named g0, g1, ..."""
    if len(inputs) > MOST_INPUTS:
        raise ValueError(f"at most {MOST_INPUTS} inputs, got {len(inputs)}")
    terms = [F.lit(1.0), *inputs, label]
    pairs = combinations_with_replacement(range(len(terms)), 2)
    return {f"g{n}": F.sum(terms[i] * terms[j]) for n, (i, j) in enumerate(pairs)}


def solve(sums: Sequence[Column], inputs: int) -> Column:
    """Intercept and weights from the Gram sums; of several solutions the shortest weights."""
    size = inputs + 2
    upper = np.triu_indices(size)

    @F.pandas_udf("array<double>")
    def solved(flat: pd.Series) -> pd.Series:
        if not len(flat):
            return flat
        gram = np.zeros((len(flat), size, size))
        gram[:, upper[0], upper[1]] = np.stack(flat.to_numpy())
        gram[:, upper[1], upper[0]] = gram[:, upper[0], upper[1]]
        means = gram[:, 0, 1:] / gram[:, :1, 0]
        spread = gram[:, 1:, 1:] / gram[:, :1, :1] - means[:, :, None] * means[:, None]
        # Scaled by the spread of each input, so that SMALL means the same for all.
        scale = np.sqrt(np.maximum(np.diagonal(spread, axis1=1, axis2=2)[:, :-1], 0))
        scale = np.where(scale > 1e-12 * (1 + np.abs(means[:, :-1])), scale, np.inf)
        shape = spread[:, :-1, :-1] / scale[:, :, None] / scale[:, None]
        right = spread[:, :-1, -1] / scale
        weights = np.einsum("nij,nj->ni", np.linalg.pinv(shape, SMALL, hermitian=True), right) / scale
        start = means[:, -1] - (weights * means[:, :-1]).sum(axis=1)
        return pd.Series(np.concatenate((start[:, None], weights), axis=1).tolist())

    return solved(F.array(*sums))


def fit_per_series(
    rows: DataFrame, key: Sequence[str], inputs: Sequence[str], label: str
) -> DataFrame:
    """Per series: key, n_rows, intercept and weights, over the rows that have all values."""
    rows = present(rows, [*inputs, label])
    sums = gram_sums([F.col(c).cast("double") for c in inputs], F.col(label).cast("double"))
    grams = rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_rows"), *[c.alias(n) for n, c in sums.items()]
    )
    solved = grams.select(*key, "n_rows", solve([F.col(n) for n in sums], len(inputs)).alias("w"))
    return solved.select(
        *key,
        "n_rows",
        F.get("w", F.lit(0)).alias("intercept"),
        F.slice("w", 2, len(inputs)).alias("weights"),
    )


def recursion(history: Column, weights: Column, intercept: Column, horizon: int) -> Column:
    """The next ``horizon`` values; history and weights are arrays of one length, oldest first."""

    def step(values: Column, _: Column) -> Column:
        newest = F.slice(values, -F.size(weights), F.size(weights))
        ahead = F.aggregate(
            F.zip_with(newest, weights, lambda v, w: v * w), intercept, lambda a, b: a + b
        )
        return F.concat(values, F.array(ahead))

    made = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), history, step)
    return F.slice(made, F.size(history) + 1, horizon)


def rolling_backtest(
    table: DataFrame,
    cuts: Sequence[object],
    key: Sequence[str],
    lags: int = 7,
    horizon: int = 7,
    freq: str = "D",
) -> DataFrame:
    """Train at every cut, forecast the steps after it, and compare: one row per series and cut.

    For each cut and series an autoregression on ``lags`` values is fitted on the rows up to the
    cut. The rows are read once: each adds to the sums of the first cut that it is a
    training row of, and running totals over the cuts give every cut its own. Forecasts start
    from the last values up to the cut; they are compared where the truth has their time.
    Series without ``lags`` values up to a cut, or without a training row, are left out there.

    Columns: key, cut, n_train, n_points, mae, rmse (null without a time in common).
    """
    marks = sorted(set(cuts))
    if not marks:
        raise ValueError("no cuts given")
    names = [f"lag_{n}" for n in range(lags, 0, -1)]
    order = ["datetime", "value"]
    rows = present(table.select(*key, *order), order)
    rows = settle_table(window_features(rows, key, order, lags=range(1, lags + 1)))
    at = F.array(*[F.lit(m).cast("timestamp_ntz") for m in marks])
    first = F.filter(at, lambda m: m >= F.col("datetime"))
    placed = rows.withColumn("cut", F.get(first, F.lit(0))).where("cut is not null")
    complete = present(placed, names)
    sums = gram_sums([F.col(n) for n in names], F.col("value"))
    parts = complete.groupBy(*key, "cut").agg(
        F.count(F.lit(1)).alias("n_train"), *[c.alias(n) for n, c in sums.items()]
    )
    # A row for every cut from the first one that a series has rows for: as many as cuts.
    every = parts.groupBy(*key).agg(F.min("cut").alias("__first"))
    later = F.filter(at, lambda m: m >= F.col("__first"))
    every = every.select(*key, F.explode(later).alias("cut"))
    through = Window.partitionBy(*key).orderBy("cut").rowsBetween(Window.unboundedPreceding, 0)
    totals = match_keys(every, parts, [*key, "cut"], "left")
    totals = totals.select(
        *key, "cut", *[F.coalesce(F.sum(n).over(through), F.lit(0)).alias(n) for n in ["n_train", *sums]]
    )
    fitted = totals.select(
        *key, "cut", "n_train", solve([F.col(n) for n in sums], lags).alias("__w")
    )
    # The newest row of each stretch between cuts; where one has none, that of an earlier one.
    values = F.array(*[F.col(n) for n in names[1:]], F.col("value"))
    newest = complete.groupBy(*key, "cut").agg(
        F.max(F.struct("datetime", "value", values.alias("history"))).alias("__last")
    )
    known = match_keys(fitted, newest, [*key, "cut"], "left")
    known = known.withColumn("__last", F.last("__last", ignorenulls=True).over(through))
    ahead = recursion(
        F.col("__last.history"), F.slice("__w", 2, lags), F.get("__w", F.lit(0)), horizon
    )
    steps = known.select(
        *key, "cut", "n_train", F.col("__last.datetime").alias("__from"),
        F.posexplode(ahead).alias("__step", "forecast"),
    )
    time = F.col("__from") + step_interval(freq, F.col("__step") + 1)
    made = steps.select(*key, "cut", "n_train", time.alias("datetime"), "forecast")
    pairs = match_keys(made, rows.select(*key, *order), [*key, "datetime"], "left")
    y, p = F.col("value"), F.when(F.col("value").isNotNull(), F.col("forecast"))
    return pairs.groupBy(*key, "cut", "n_train").agg(
        F.count("value").alias("n_points"), mae(y, p).alias("mae"), rmse(y, p).alias("rmse")
    )
