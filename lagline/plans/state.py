"""The newest values of every series, kept between runs.

A state has one row per series: its key and ``history``, the newest ``keep`` pairs of time and
value, oldest first. Merging the state with new rows keeps the newest of both, so loads may
come in any order, late rows included, and a run reads the state and its new rows only.
Every row is to be loaded once: a row that comes twice counts twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline.operators.filters import history_tail
from lagline.sources.versions import new_version, newest_version, publish

ORDER = ["datetime", "value"]


def history_state(rows: DataFrame, key: Sequence[str], keep: int) -> DataFrame:
    """The state of rows with ``datetime`` and ``value``."""
    tail = history_tail(rows.select(*key, *ORDER), key, keep, ORDER)
    history = F.array_sort(F.collect_list(F.struct(*ORDER))).alias("history")  # at most keep
    return tail.groupBy(*key).agg(history)


def state_rows(state: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of a state: key, datetime, value."""
    return state.select(*key, F.inline("history"))


def merge_states(states: Sequence[DataFrame], key: Sequence[str], keep: int) -> DataFrame:
    """One state of several; no series sends on more than ``keep`` rows of each."""
    rows = state_rows(states[0], key)
    for state in states[1:]:
        rows = rows.unionByName(state_rows(state, key))
    return history_state(rows, key, keep)


def load_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete state below a path, or None."""
    folder = newest_version(spark, path)
    return None if folder is None else spark.read.parquet(f"{folder}/state")


def update_state(
    spark: SparkSession, path: str, rows: DataFrame, key: Sequence[str], keep: int
) -> DataFrame:
    """Merge new rows into the state kept below ``path`` and return the new state."""
    before, made = load_state(spark, path), history_state(rows, key, keep)
    state = made if before is None else merge_states([before, made], key, keep)
    folder = new_version(path)
    state.write.parquet(f"{folder}/state")
    publish(spark, folder, {"kind": "history", "key": list(key), "keep": keep})
    return spark.read.parquet(f"{folder}/state")
