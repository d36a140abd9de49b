"""Row-based lag, rolling, target and sequence columns per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from lagline.functions.clean import epoch_micros
from lagline.operators.series import (
    UNKNOWN,
    Known,
    over_series,
    quantiles_of_counts,
    value_counts,
)
from lagline.session import settle

DAY_SECONDS = 86_400


def rolling_mean(value: str, n: int, window: WindowSpec) -> Column:
    """Mean of the n rows before the current one; null unless all n have a value."""
    rows = window.rowsBetween(-n, -1)
    return F.when(F.count(value).over(rows) == n, F.avg(value).over(rows))


def window_features(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    value: str = "value",
    lags: Sequence[int] = (),
    rolls: Sequence[int] = (),
    target: str | None = None,
    longer: Known = UNKNOWN,
) -> DataFrame:
    """``lag_n``, ``roll_n`` and the next value, all from one shuffle and one sort."""

    def add(rows: DataFrame, window: WindowSpec) -> DataFrame:
        columns = {f"lag_{n}": F.lag(value, n).over(window) for n in lags}
        columns |= {f"roll_{n}": rolling_mean(value, n, window) for n in rolls}
        if target:
            columns[target] = F.lead(value, 1).over(window)
        return rows.withColumns(columns)

    back = max([0, *lags, *rolls])
    return over_series(df, key, order, add, back, 1 if target else 0, longer)


def time_gaps(
    df: DataFrame,
    key: Sequence[str],
    time: str = "datetime",
    longer: Known = UNKNOWN,
) -> DataFrame:
    """Seconds since the row before in the same series; null for its first row."""

    def add(rows: DataFrame, window: WindowSpec) -> DataFrame:
        micros = F.col("__micros") - F.lag("__micros", 1).over(window)
        return rows.withColumn("gap_seconds", micros / 1_000_000)

    rows = df.select(*key, epoch_micros(F.col(time)).alias("__micros"))
    return over_series(rows, key, ["__micros"], add, back=1, longer=longer).drop("__micros")


def median_gap(
    df: DataFrame,
    key: Sequence[str],
    time: str = "datetime",
    longer: Known = UNKNOWN,
) -> DataFrame:
    """One row: the median gap in seconds over all series."""
    gaps = settle(value_counts(time_gaps(df, key, time, longer), [], "gap_seconds"))
    median = quantiles_of_counts(gaps, [], "gap_seconds", [0.5])
    return median.select(F.get("quantiles", F.lit(0)).alias("median_gap_seconds"))


def is_daily(
    df: DataFrame,
    key: Sequence[str],
    time: str = "datetime",
    longer: Known = UNKNOWN,
) -> bool:
    """Whether the median gap is a day or more; hourly when that is undefined.

    Counts on either side of a day decide; only with as many on both is the median the mean
    of the two gaps in the middle, the largest below and the least from a day on.
    """
    gap = F.col("gap_seconds")
    far = gap >= DAY_SECONDS
    row = time_gaps(df, key, time, longer).agg(
        F.count(gap).alias("gaps"),
        F.count_if(far).alias("far"),
        F.max(F.when(~far, gap)).alias("below"),
        F.min(F.when(far, gap)).alias("above"),
    ).first()
    if row.gaps == 0 or row.far * 2 != row.gaps:
        return row.far * 2 > row.gaps
    return row.below + row.above >= 2 * DAY_SECONDS


def sequences(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    value: str,
    length: int,
    name: str = "sequence",
) -> DataFrame:
    """Each row with the ``length`` values before it, oldest first; full ones only."""

    def add(rows: DataFrame, window: WindowSpec) -> DataFrame:
        earlier = [F.lag(value, n).over(window) for n in range(length, 0, -1)]
        return rows.withColumn(name, F.array(*earlier))

    rows = over_series(df, key, order, add, back=length)
    return rows.where(~F.exists(name, F.isnull))
