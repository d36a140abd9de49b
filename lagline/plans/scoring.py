"""Scoring batches of rows with a fitted model."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lagline.functions.clean import quoted
from lagline.plans.models import load_model
from lagline.sources.columns import scoring_columns
from lagline.sources.sinks import write_parquet


class Transformer(Protocol):
    def transform(self, dataset: DataFrame) -> DataFrame: ...


def score_rows(
    rows: DataFrame,
    model: Transformer,
    saved_features: Sequence[str] | None = None,
    vector: str = "__features",
) -> DataFrame:
    """Every input row with its prediction; an empty batch stays empty.

    ``vector`` is the column the model reads its features from.
    """
    assembler = VectorAssembler(
        inputCols=[*map(quoted, scoring_columns(rows, saved_features))],
        outputCol=vector,
        handleInvalid="keep",
    )
    return model.transform(assembler.transform(rows)).drop(vector)


def score_files(
    spark: SparkSession, rows: str, schema: T.StructType | str, model: str, out: str
) -> DataFrame:
    """Score the JSON rows below a path with a saved forest and write them with forecasts."""
    saved = load_model(spark, model)
    scored = score_rows(spark.read.schema(schema).json(rows), saved.model, saved.features)
    return spark.read.parquet(write_parquet(scored, out))
