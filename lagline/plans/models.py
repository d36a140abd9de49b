"""Fitted models, and where they are kept."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline.functions.clean import epoch_micros
from lagline.operators.series import broadcast_if_short, match_keys
from lagline.sources.versions import new_version, newest_version, publish

DAY_SECONDS = 86_400.0


@dataclass
class ForestModel:
    """A forest and the feature columns it was fitted on."""

    model: RandomForestRegressionModel
    features: list[str]


@dataclass
class Scaling:
    """Mean and standard deviation per series, and over all series for unknown ones."""

    key: list[str]
    mean: float
    std: float
    per_series: DataFrame | None = None

    def attach(self, rows: DataFrame) -> DataFrame:
        """Add ``mean`` and ``std`` to every row."""
        whole = {"mean": F.lit(self.mean), "std": F.lit(self.std)}
        if self.per_series is None or not self.key:
            return rows.withColumns(whole)
        known = self.per_series.select(
            *self.key, F.col("mean").alias("__mean"), F.col("std").alias("__std")
        )
        found = match_keys(rows, broadcast_if_short(known), self.key, "left")
        return found.withColumns(
            {n: F.coalesce(F.col(f"__{n}"), c) for n, c in whole.items()}
        ).drop("__mean", "__std")


@dataclass
class SequenceModel:
    """Linear one-step prediction from the last ``seq_len`` standardised values."""

    seq_len: int
    weights: list[float]
    intercept: float
    scaling: Scaling


@dataclass
class SeasonalDesign:
    """The columns of the seasonal regression as a function of time."""

    origin: int  # microseconds since 1970
    span: float  # seconds
    changepoints: list[float]  # shares of the span
    harmonics: list[tuple[float, int]]  # (period in seconds, order)
    dropped: list[str] = field(default_factory=list)

    def columns(self, time: Column) -> list[Column]:
        """Piecewise linear trend and Fourier terms."""
        micros = epoch_micros(time)
        share = (micros - F.lit(self.origin)) / F.lit(self.span * 1_000_000)
        trend = [share] + [F.greatest(share - c, F.lit(0.0)) for c in self.changepoints]
        angles = [
            (micros / F.lit(period * 1_000_000)) * F.lit(order) * (2 * F.pi())
            for period, order in self.harmonics
        ]
        waves = [wave(angle) for angle in angles for wave in (F.sin, F.cos)]
        return [*trend, *waves]


@dataclass
class SeasonalModel:
    """Additive trend and seasonality over standardised values."""

    design: SeasonalDesign
    weights: list[float]
    intercept: float
    scaling: Scaling


Model = ForestModel | SequenceModel | SeasonalModel


def model_kind(model: Model) -> str:
    return {ForestModel: "rf", SeasonalModel: "prophet", SequenceModel: "lstm"}[type(model)]


def save_model(spark: SparkSession, model: Model, path: str) -> str:
    """Keep a model below ``path`` as its newest version, and return ``path``.

    Every version has a folder of its own, and its description is written last. Readers take the
    newest version that has one, so they see the version before or the whole new one, and a
    model may be saved where it was loaded from. Earlier versions stay until
    :func:`prune_versions`.
    """
    folder = new_version(path)
    publish(spark, folder, write_parts(model, folder))
    return path


def write_parts(model: Model, folder: str) -> dict:
    """Write what a model needs besides its description, and return the description."""
    meta: dict = {"kind": model_kind(model)}
    if isinstance(model, ForestModel):
        model.model.write().save(f"{folder}/model")
        return meta | {"features": model.features}
    scaling = model.scaling
    meta |= {
        "weights": model.weights,
        "intercept": model.intercept,
        "key": scaling.key,
        "scaler": {"mean": scaling.mean, "std": scaling.std},
    }
    if scaling.per_series is not None:
        scaling.per_series.write.parquet(f"{folder}/scaler")
    if isinstance(model, SequenceModel):
        return meta | {"seq_len": model.seq_len}
    return meta | {"design": asdict(model.design)}


def load_meta(spark: SparkSession, path: str) -> dict:
    """The description of the newest complete version, or of a model without versions."""
    folder = newest_version(spark, path) or path
    try:
        return json.loads(spark.read.text(f"{folder}/meta", wholetext=True).first()[0])
    except AnalysisException as error:
        raise FileNotFoundError(f"no model description below {path}") from error


def load_model(spark: SparkSession, path: str) -> Model:
    path = newest_version(spark, path) or path  # one version for all parts
    meta = load_meta(spark, path)
    if meta["kind"] == "rf":
        if "features" not in meta:
            raise KeyError(f"the model below {path} lists no features")
        return ForestModel(RandomForestRegressionModel.load(f"{path}/model"), meta["features"])
    key = meta["key"]
    table = spark.read.parquet(f"{path}/scaler") if key else None
    scaling = Scaling(key, *scaler_values(meta), table)
    if meta["kind"] == "lstm":
        if "seq_len" not in meta:
            raise KeyError(f"the model below {path} has no seq_len")
        return SequenceModel(meta["seq_len"], meta["weights"], meta["intercept"], scaling)
    design = SeasonalDesign(**meta["design"])
    return SeasonalModel(design, meta["weights"], meta["intercept"], scaling)


def scaler_values(meta: dict) -> tuple[float, float]:
    """Mean and standard deviation, given directly or under ``scaler``."""
    for place in (meta, meta.get("scaler")):
        if isinstance(place, dict) and {"mean", "std"} <= place.keys():
            return float(place["mean"]), float(place["std"])
    raise KeyError(f"no mean and std in {sorted(meta)}")
