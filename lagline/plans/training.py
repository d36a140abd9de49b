"""Training jobs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.functions.clean import epoch_micros, from_zscore, present, quoted, zscore
from lagline.functions.history import weighted_sum
from lagline.operators.metrics import scaler, slice_metrics
from lagline.operators.series import with_position
from lagline.operators.splits import holdout
from lagline.operators.windows import median_gap, sequences
from lagline.plans.features import FeatureTable, daily_features
from lagline.plans.models import (
    DAY_SECONDS,
    ForestModel,
    Model,
    Scaling,
    SeasonalDesign,
    SeasonalModel,
    SequenceModel,
)
from lagline.session import settle, settle_table
from lagline.sources.columns import series_key

# Forest size, holdout share, sequence length and seasonal components.
TREES = 300
DEPTH = 12
BINS = 32
SEED = 42
HOLDOUT = 0.2
SEQ_LEN = 30
COMPONENTS = {"daily": (1.0, 4), "weekly": (7.0, 3), "yearly": (365.25, 10)}
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8

# Our own settings.
RIDGE = 0.01


class Trained(NamedTuple):
    """A fitted model, its one-row metrics, and the scored rows they come from."""

    model: Model
    metrics: DataFrame
    scored: DataFrame


def train_forest(
    table: FeatureTable,
    key: Sequence[str] = (),
    split_key: Sequence[str] = (),
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
    share: float = HOLDOUT,
    bootstrap: bool = True,
    bins: int = BINS,
) -> Trained:
    """Forest regressor on a feature table, split by time.

    The split runs over the whole table unless ``split_key`` asks for one per series.
    ``bootstrap`` draws the rows of each tree anew; otherwise every tree sees all. A feature of
    up to ``bins`` values is split between any two of them, in up to ``bins`` squared rows.
    """
    rows = present(table.frame, [*table.features, "target"])
    kept = dict.fromkeys([*key, "datetime", "value", *table.features, "target"])
    order = ["datetime", *key, "value"]
    labelled = settle_table(holdout(rows.select(*map(quoted, kept)), order, split_key, share))
    assembler = VectorAssembler(inputCols=[*map(quoted, table.features)], outputCol="__features")
    vectors = assembler.transform(labelled)
    forest = RandomForestRegressor(
        featuresCol="__features",
        labelCol="target",
        predictionCol="forecast",
        numTrees=trees,
        maxDepth=depth,
        maxBins=bins,
        seed=seed,
        featureSubsetStrategy="all",
        bootstrap=bootstrap,
    )
    fitted = forest.fit(vectors.where("slice = 'train'"))
    scored = fitted.transform(vectors).drop("__features")
    return Trained(ForestModel(fitted, list(table.features)), slice_metrics(scored), scored)


def fit_scaling(rows: DataFrame, key: Sequence[str]) -> Scaling:
    """Scaler statistics of the given rows, overall and per series."""
    overall = scaler(rows).first()
    if overall["mean"] is None:
        raise ValueError("no rows to fit on")
    table = settle(scaler(rows, key)) if key else None  # read again by every attach
    return Scaling(list(key), overall["mean"], overall["std"], table)


def fit_linear(
    rows: DataFrame, inputs: Sequence[Column], label: Column, ridge: float
) -> tuple[list[float], float]:
    """Least squares in one pass over the rows; weights and intercept."""
    regression = LinearRegression(
        featuresCol="__x", labelCol="__y", solver="normal", regParam=ridge, elasticNetParam=0.0
    )
    fitted = regression.fit(
        rows.select(array_to_vector(F.array(*inputs)).alias("__x"), label.alias("__y"))
    )
    return fitted.coefficients.tolist(), float(fitted.intercept)


def gram_matrix(rows: DataFrame, columns: Sequence[Column]) -> np.ndarray:
    """Sums over all rows of the products of 1 and the columns, in one pass.

    Every task hands on one matrix; they are added up before anything comes to the driver.
    """
    size = len(columns) + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            terms = np.ones((batch.num_rows, size))
            terms[:, 1:] = flat.reshape(batch.num_rows, size - 1)
            total += terms.T @ terms
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()])], ["sums"])

    terms = rows.select(F.array(*[c.cast("double") for c in columns]).alias("terms"))
    parts = terms.mapInArrow(work, "sums array<double>")
    cells = parts.select(F.posexplode("sums").alias("at", "part")).groupBy("at")
    out = np.zeros(size * size)
    for cell in cells.agg(F.sum("part").alias("total")).collect():  # (columns + 1) squared
        out[cell.at] = cell.total
    return out.reshape(size, size)


def sparse_weights(
    gram: np.ndarray, penalised: Sequence[int], penalty: float, rounds: int = 100_000
) -> tuple[list[float], float]:
    """Weights and intercept of least squares with ``penalty`` on the absolute values of some.

    ``gram`` is that of the inputs and then the label; it minimises half the mean squared
    residual plus the penalty, by coordinate descent after the free weights are eliminated.
    """
    means = gram[0, 1:] / gram[0, 0]
    spread = gram[1:, 1:] / gram[0, 0] - np.outer(means, means)
    inner, right = spread[:-1, :-1], spread[:-1, -1]
    held = np.array(sorted(penalised), int)
    free = np.setdiff1d(np.arange(len(inner)), held)
    inverse = np.linalg.pinv(inner[np.ix_(free, free)], 1e-10, hermitian=True)
    across = inner[np.ix_(held, free)] @ inverse
    shape = inner[np.ix_(held, held)] - across @ inner[np.ix_(free, held)]
    target = right[held] - across @ right[free]
    weights, own = np.zeros(len(held)), np.diag(shape)
    for _ in range(rounds):
        moved = 0.0
        for j in np.flatnonzero(own > 1e-14):
            pull = target[j] - shape[j] @ weights + own[j] * weights[j]
            new = np.sign(pull) * max(abs(pull) - penalty, 0.0) / own[j]
            moved = max(moved, abs(new - weights[j]) * own[j])
            weights[j] = new
        if moved < 1e-12:
            break
    out = np.zeros(len(inner))
    out[held] = weights
    out[free] = inverse @ (right[free] - inner[np.ix_(free, held)] @ weights)
    return out.tolist(), float(means[-1] - out @ means[:-1])


def train_sequence(
    table: DataFrame,
    key: Sequence[str] | None = None,
    seq_len: int = SEQ_LEN,
    share: float = HOLDOUT,
    scale_on: str = "train",
    ridge: float = 0.0,
) -> Trained:
    """Linear autoregression on the last ``seq_len`` standardised values.

    The first ``1 - share`` of each series' sequences are for training. ``scale_on``
    fits the scaler on the rows those sequences cover (``train``) or on all rows (``all``).
    """
    if scale_on not in ("train", "all"):
        raise ValueError(f"scale_on must be train or all, got {scale_on!r}")
    key = series_key(table.columns, key)
    order = ["datetime", "value"]
    rows = with_position(table.select(*key, *order), key, order, "__position", "__size")
    complete = F.greatest(F.col("__size") - seq_len, F.lit(0))
    train = F.col("__position") <= seq_len + F.floor(complete * F.lit(1 - share))
    label = F.when(train, "train").otherwise("validation")
    # Settled before the sequences are formed: they are seq_len times as wide.
    rows = settle_table(rows.withColumn("slice", label).drop("__position", "__size"))
    fitted_on = rows.where("slice = 'train'") if scale_on == "train" else rows
    scaling = fit_scaling(fitted_on, key)
    pairs = scaling.attach(sequences(rows, key, order, "value", seq_len))
    mean, std = F.col("mean"), F.col("std")
    inputs = [zscore(F.get("sequence", F.lit(i)), mean, std) for i in range(seq_len)]
    weights, intercept = fit_linear(
        pairs.where("slice = 'train'"), inputs, zscore(F.col("value"), mean, std), ridge
    )
    predicted = weighted_sum(inputs, weights) + F.lit(intercept)
    scored = pairs.withColumn("forecast", from_zscore(predicted, mean, std)).drop(
        "sequence", "mean", "std"
    )
    model = SequenceModel(seq_len, weights, intercept, scaling)
    return Trained(model, slice_metrics(scored, "value"), scored)


def seasonal_design(
    train: DataFrame,
    key: Sequence[str],
    changepoints: int = CHANGEPOINTS,
    components: Sequence[str] | None = None,
) -> SeasonalDesign:
    """Trend and seasonal terms that the training rows can tell apart.

    By default a component needs two whole periods of data, and a harmonic a period of more
    than two steps; anything else could not be told from a constant or a trend. Components
    that are named are taken with all their harmonics. The trend has at most
    ``changepoints`` bends, fewer with as few times.
    """
    micros = epoch_micros(F.col("datetime"))
    first, last, moments = train.agg(
        F.min(micros), F.max(micros), F.count_distinct("datetime")
    ).first()
    if first is None or first == last:
        raise ValueError("need at least two different times to fit on")
    span = (last - first) / 1_000_000
    step = median_gap(train, key).first()[0] or 0.0
    harmonics, dropped = [], []
    for name, (days, orders) in COMPONENTS.items():
        period = days * DAY_SECONDS
        usable = [n for n in range(1, orders + 1) if period / n > 2 * step]
        if components is not None:
            if name in components:
                harmonics += [(period, n) for n in range(1, orders + 1)]
            else:
                dropped.append(name)
        elif span < 2 * period or not usable:
            dropped.append(name)
        else:
            harmonics += [(period, n) for n in usable]
    bends = min(changepoints, max(moments - 1, 0))
    at = [CHANGEPOINT_RANGE * i / (bends + 1) for i in range(1, bends + 1)]
    return SeasonalDesign(first, span, at, harmonics, dropped)


def train_seasonal(
    table: DataFrame,
    key: Sequence[str] | None = None,
    share: float = HOLDOUT,
    ridge: float = RIDGE,
    changepoints: int = CHANGEPOINTS,
    components: Sequence[str] | None = None,
    sparse: float | None = None,
) -> Trained:
    """Additive regression on a piecewise linear trend and Fourier seasonality.

    With ``sparse`` the trend's bends are selected: their absolute weights are penalised by so
    much (see :func:`sparse_weights`) instead of the ridge on all weights, and most become zero.
    """
    key = series_key(table.columns, key)
    order = ["datetime", "value"]
    rows = settle_table(holdout(table.select(*key, *order), order, key, share))
    train = rows.where("slice = 'train'")
    scaling = fit_scaling(train, key)
    design = seasonal_design(train, key, changepoints, components)
    scaled = scaling.attach(rows)
    mean, std = F.col("mean"), F.col("std")
    terms = design.columns(F.col("datetime"))
    label, training = zscore(F.col("value"), mean, std), scaled.where("slice = 'train'")
    if sparse is None:
        weights, intercept = fit_linear(training, terms, label, ridge)
    else:
        bends = range(1, len(design.changepoints) + 1)
        weights, intercept = sparse_weights(gram_matrix(training, [*terms, label]), bends, sparse)
    predicted = weighted_sum(terms, weights) + F.lit(intercept)
    scored = scaled.withColumn("forecast", from_zscore(predicted, mean, std))
    scored = scored.drop("mean", "std")
    model = SeasonalModel(design, weights, intercept, scaling)
    return Trained(model, slice_metrics(scored, "value"), scored)


def train(
    table: DataFrame, model: str = "rf", key: Sequence[str] | None = None, **settings: object
) -> Trained:
    """Train the named model on a loaded daily table.

    The key is the station and pollutant columns unless given; an empty one pools all rows.
    """
    key = series_key(table.columns, key)
    if model == "rf":
        return train_forest(daily_features(table, key=key), key, **settings)
    if model == "prophet":
        return train_seasonal(table, key, **settings)
    if model == "lstm":
        return train_sequence(table, key, **settings)
    raise ValueError(f"unknown model {model!r}")
