"""Expressions over a series' recent values held as an array, oldest first."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def back(history: Column, n: int) -> Column:
    """The n-th value from the end; 1 is the newest."""
    return F.element_at(history, -n)


def mean_of(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(values) > 0, total / F.size(values)).otherwise(F.lit(float("nan")))


def mean_before_newest(history: Column, n: int) -> Column:
    """Mean of up to n values that precede the newest; NaN when there is none."""
    count = F.least(F.lit(n), F.size(history) - 1)
    return F.when(
        count > 0, mean_of(F.slice(history, F.size(history) - count, F.greatest(count, F.lit(0))))
    ).otherwise(F.lit(float("nan")))


def push(history: Column, value: Column, keep: int) -> Column:
    """Append a value and keep the newest ``keep``."""
    longer = F.concat(history, F.array(value))
    return F.slice(longer, F.greatest(F.size(longer) - keep + 1, F.lit(1)), keep)


def weighted_sum(values: Sequence[Column], weights: Sequence[float]) -> Column:
    return reduce(Column.__add__, [v * F.lit(w) for v, w in zip(values, weights, strict=True)])


def dot(values: Column, weights: Sequence[float]) -> Column:
    """:func:`weighted_sum` of the elements of an array."""
    products = F.zip_with(values, F.array(*map(F.lit, weights)), lambda v, w: v * w)
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def recur(history: Column, weights: Sequence[float], intercept: float, horizon: int) -> Column:
    """Feed each linear one-step prediction back as input; the ``horizon`` predictions.

    ``weights`` line up with the last ``len(weights)`` values, oldest first.
    """
    size = len(weights)
    start = F.slice(history, -size, size)
    grown = F.aggregate(
        F.sequence(F.lit(1), F.lit(horizon)),
        start,
        lambda acc, _: F.concat(
            acc, F.array(dot(F.slice(acc, -size, size), weights) + F.lit(float(intercept)))
        ),
    )
    return F.slice(grown, size + 1, horizon)
