"""Distribution change between the ``reference`` and the ``current`` slice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from lagline.functions.clean import present
from lagline.operators.series import (
    attach_by_key,
    long_series,
    over_series,
    quantiles,
    running_totals,
)
from lagline.session import settle_table

# Our own settings: the drift test and its limits are parameters with these defaults.
KS_P_VALUE = 0.05
WASSERSTEIN_LIMIT = 0.1
METHOD = "ks"
DRIFT_SHARE = 0.5
TAIL_SHARE = 0.05
HISTOGRAM_BINS = 10


def median_drift(
    labelled: DataFrame,
    key: Sequence[str] = (),
    value: str = "value",
    quantile_method: str = "exact",
) -> DataFrame:
    """Absolute difference of the slice medians; for ``quantile_method`` see ``quantiles``."""
    medians = quantiles(labelled, [*key, "slice"], value, [0.5], method=quantile_method)

    def of(label: str) -> Column:
        return F.max(F.when(F.col("slice") == label, F.get("quantiles", F.lit(0))))

    return medians.groupBy(*key).agg(
        F.abs(of("current") - of("reference")).alias("drift_score")
    )


def error_histogram(
    labelled: DataFrame, key: Sequence[str] = (), bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Rows per slice in ``bins`` equal steps between the least and greatest error."""
    errors = labelled.select(
        *key, "slice", (F.col("forecast") - F.col("value")).alias("__error")
    )
    spans = errors.groupBy(*key).agg(
        F.min("__error").alias("__low"), F.max("__error").alias("__high")
    )
    if key:
        placed = attach_by_key(errors, spans, key)
    else:
        low, high = spans.first()
        placed = errors.withColumns({"__low": F.lit(low), "__high": F.lit(high)})
    width = (F.col("__high") - F.col("__low")) / bins
    step = F.when(width > 0, F.floor((F.col("__error") - F.col("__low")) / width))
    bin_no = F.least(F.coalesce(step, F.lit(0)), F.lit(bins - 1))
    return (
        placed.withColumns(
            {
                "bin": bin_no,
                "bin_low": F.col("__low") + width * bin_no,
                "bin_high": F.col("__low") + width * (bin_no + 1),
            }
        )
        .groupBy(*key, "slice", "bin", "bin_low", "bin_high")
        .agg(F.count(F.lit(1)).alias("n_points"))
    )


def largest_errors(
    labelled: DataFrame,
    key: Sequence[str] = (),
    share: float = TAIL_SHARE,
    quantile_method: str = "exact",
) -> DataFrame:
    """The most under- and overestimated rows of each slice against the majority.

    For ``quantile_method`` see ``quantiles``; the counts of a sketch are those of its cuts.
    """
    group = [*key, "slice"]
    rows = labelled.withColumn("__error", F.col("forecast") - F.col("value"))
    tails = [share, 1 - share]
    cuts = quantiles(rows, group, "__error", tails, "__cuts", quantile_method)
    cut = attach_by_key(rows, cuts, group)
    part = (
        F.when(F.col("__error") <= F.get("__cuts", F.lit(0)), "underestimated")
        .when(F.col("__error") >= F.get("__cuts", F.lit(1)), "overestimated")
        .otherwise("majority")
    )
    return (
        cut.withColumn("part", part)
        .groupBy(*group, "part")
        .agg(
            F.count(F.lit(1)).alias("n_points"),
            F.avg("__error").alias("mean_error"),
            F.avg("value").alias("mean_value"),
            F.avg("forecast").alias("mean_forecast"),
        )
    )


def ks_p_value(distance: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value."""
    at = distance * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * at * at),
    )
    # Below 0.2 the sum needs ever more terms while the value is 1 to ten places.
    return F.when(at < 0.2, 1.0).otherwise(F.greatest(F.least(series, F.lit(1.0)), F.lit(0.0)))


def column_distances(
    labelled: DataFrame,
    key: Sequence[str] = (),
    columns: Sequence[str] = ("value", "forecast"),
) -> DataFrame:
    """Kolmogorov-Smirnov and Wasserstein distance of the two slices per column.

    Both follow from the running share of each slice over the pooled distinct values,
    so rows are counted per value before anything is ordered.
    """
    group = [*key, "column"]
    cells = labelled.select(*key, "slice", *columns).unpivot(
        [*key, "slice"], list(columns), "column", "__x"
    )

    def rows_in(label: str) -> Column:
        return F.count(F.when(F.col("slice") == label, True))

    counted = settle_table(  # read three times below
        present(cells, ["__x"])
        .groupBy(*group, "__x")
        .agg(rows_in("reference").alias("__r"), rows_in("current").alias("__c"))
    )
    sizes = counted.groupBy(*group).agg(
        F.sum("__r").alias("n_reference"),
        F.sum("__c").alias("n_current"),
        F.try_divide(F.sum(F.col("__x") * F.col("__r")), F.sum("__r")).alias("__mean"),
    )

    def gap_to_next(rows: DataFrame, window: WindowSpec) -> DataFrame:
        return rows.withColumn("__gap", F.lead("__x", 1).over(window) - F.col("__x"))

    longer = long_series(counted, group)
    through = running_totals(counted, group, ["__x"], {"__fr": "__r", "__fc": "__c"}, longer)
    through = over_series(through, group, ["__x"], gap_to_next, ahead=1, longer=longer)
    apart = F.abs(
        F.try_divide(F.col("__fr"), F.col("n_reference"))
        - F.try_divide(F.col("__fc"), F.col("n_current"))
    )
    off = F.col("__x") - F.col("__mean")
    squares = F.sum(off * off * F.col("__r"))
    return (
        attach_by_key(through, sizes, group)
        .groupBy(*group, "n_reference", "n_current")
        .agg(
            F.max(apart).alias("ks_distance"),
            F.sum(apart * F.coalesce("__gap", F.lit(0.0))).alias("wasserstein"),
            F.sqrt(F.try_divide(squares, F.col("n_reference"))).alias("reference_std"),
        )
    )


def column_drift(
    labelled: DataFrame,
    key: Sequence[str] = (),
    columns: Sequence[str] = ("value", "forecast"),
    p_value: float = KS_P_VALUE,
    wasserstein_limit: float = WASSERSTEIN_LIMIT,
    method: str = METHOD,
) -> DataFrame:
    """Drift decision per column, whatever the number of rows.

    ``method`` is ``ks`` (Kolmogorov-Smirnov, by its p-value) or ``wasserstein`` (distance
    over the reference's standard deviation); both statistics are returned. A slice without
    rows never drifts.
    """
    if method not in ("ks", "wasserstein"):
        raise ValueError(f"method must be ks or wasserstein, got {method!r}")
    distances = column_distances(labelled, key, columns)
    n, m = F.col("n_reference"), F.col("n_current")
    both = (n > 0) & (m > 0)
    p = F.when(both, ks_p_value(F.col("ks_distance"), n, m))
    normed = F.try_divide(F.col("wasserstein"), F.col("reference_std"))
    drifted = p < p_value if method == "ks" else normed >= wasserstein_limit
    return distances.select(
        *key,
        "column",
        "n_reference",
        "n_current",
        "ks_distance",
        p.alias("ks_p_value"),
        "wasserstein",
        normed.alias("wasserstein_normed"),
        F.lit(method).alias("method"),
        F.coalesce(drifted, F.lit(False)).alias("drifted"),
    )


def dataset_drift(
    drift: DataFrame, key: Sequence[str] = (), share: float = DRIFT_SHARE
) -> DataFrame:
    """Whether at least ``share`` of the columns drifted."""
    part = F.avg(F.col("drifted").cast("double"))
    return drift.groupBy(*key).agg(
        part.alias("drifted_share"), (part >= share).alias("dataset_drift")
    )
