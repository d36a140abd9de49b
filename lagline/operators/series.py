"""Ordered work inside series of any length.

Most series fit in one task and are handled with a plain window. A series (or group)
with more rows than ``spark.lagline.maxSeriesRows`` is range-partitioned by its order
instead, so no task ever receives a whole long series. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lagline.functions.clean import present
from lagline.session import series_row_limit, settle, settle_table

Compute = Callable[[DataFrame, WindowSpec], DataFrame]

# Most rows of a per-key table that is sent to every executor.
BROADCAST_ROWS = 100_000

# "Not looked up yet", where None means that no series is long.
UNKNOWN = object()


class LongSeries(NamedTuple):
    """The keys of the series too long for one task, and their rows taken together."""

    keys: DataFrame
    rows: int


Known = LongSeries | None | object


def series_window(key: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*key).orderBy(*order)


#: Most rows of a group whose values one aggregation buffer may hold.
QUANTILE_ROWS = 200_000

#: Share of a group's rows by which a rank of the quantile sketch may be off.
SKETCH_ERROR = 0.001


def long_series(
    df: DataFrame, key: Sequence[str], most: int | None = None
) -> LongSeries | None:
    """The series with more rows than one task may sort (or than ``most``, if that is less),
    or None when there are none.

    One count per key with map-side combine; at most ``rows / limit`` keys are found.
    """
    limit = series_row_limit(df.sparkSession)
    limit = limit if most is None else min(limit, most)
    if not key:
        rows = df.count()
        return LongSeries(df.limit(0), rows) if rows > limit else None
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__size"))
    longer = sizes.where(F.col("__size") > limit)
    if longer.isEmpty():
        return None
    longer = settle(longer)
    return LongSeries(longer.select(*key), longer.agg(F.sum("__size")).first()[0])


def set_apart(
    df: DataFrame, key: Sequence[str], longer: LongSeries
) -> tuple[DataFrame, DataFrame]:
    """(rows of the series that fit in a task, rows of the long ones)."""
    if not key:
        return df.limit(0), df
    keys = broadcast_if_short(longer.keys)
    return match_keys(df, keys, key, "left_anti"), match_keys(df, keys, key, "left_semi")


def ranges_for(df: DataFrame, rows: int) -> int:
    """Range partitions that keep each below the rows one task may sort."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(usual, -(-rows // series_row_limit(df.sparkSession)))


def match_keys(left: DataFrame, right: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """Join on ``key`` with null equal to null, keeping the left key columns."""
    other = right.withColumnsRenamed({k: f"__r_{k}" for k in key})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in key])
    return left.join(other, same, how).drop(*[f"__r_{k}" for k in key])


def attach_by_key(
    rows: DataFrame, per_key: DataFrame, key: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Add the columns of a one-row-per-key table, computed once, to every row."""
    return match_keys(rows, broadcast_if_short(settle(per_key)), key, how)


def broadcast_if_short(table: DataFrame) -> DataFrame:
    """Mark a counted, short table for broadcast, so its join does not shuffle the rows.

    A longer one is joined by shuffle, where Spark splits hot keys.
    """
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def number_rows(df: DataFrame, order: Sequence[str], name: str, rows: int) -> DataFrame:
    """Zero-based position of every row in the total order, without a single-task sort.

    Rows are range-partitioned and sorted, numbered inside their partition, and
    shifted by the sizes of the partitions before. The numbered rows are settled first
    because range bounds are sampled and may differ when computed again.
    """
    local = F.monotonically_increasing_id()
    ranges = df.repartitionByRange(ranges_for(df, rows), *order)
    numbered = settle_table(ranges.sortWithinPartitions(*order).withColumn("__id", local))
    part = F.shiftright("__id", 33)
    inside = F.col("__id").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (  # one row per partition
        numbered.groupBy(part.alias("__part"))
        .count()
        .select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    )
    return (
        numbered.withColumn("__part", part)
        .join(F.broadcast(starts), "__part")
        .withColumn(name, F.col("__start") + inside)
        .drop("__id", "__part", "__start")
    )


def over_series(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    compute: Compute,
    back: int = 0,
    ahead: int = 0,
    longer: Known = UNKNOWN,
) -> DataFrame:
    """Apply window columns that look at most ``back`` rows back and ``ahead`` rows on.

    A long series is cut into segments by row position. Each segment also receives the
    ``back`` rows before it and the ``ahead`` rows after it; those copies serve as
    neighbours only and are removed afterwards. ``longer`` is the result of
    :func:`long_series` if the caller has it already.
    """
    if longer is UNKNOWN:
        longer = long_series(df, key)
    if longer is None:
        return compute(df, series_window(key, order))
    short, long = set_apart(df, key, longer)
    split = _in_segments(long, key, order, compute, back, ahead, longer.rows)
    return compute(short, series_window(key, order)).unionByName(split) if key else split


def _in_segments(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    compute: Compute,
    back: int,
    ahead: int,
    rows: int,
) -> DataFrame:
    length = max(series_row_limit(df.sparkSession), back + ahead + 1)

    def segment(position: Column) -> Column:
        return F.floor(position / length)

    at = F.col("__row")
    copies = (
        number_rows(df, [*key, *order], "__row", rows)
        .withColumn("__home", segment(at))
        .withColumn(
            "__segment",
            F.explode(
                F.sequence(segment(F.greatest(at - ahead, F.lit(0))), segment(at + back))
            ),
        )
    )
    done = compute(copies, series_window([*key, "__segment"], ["__row"]))
    return done.where("__home = __segment").drop("__row", "__home", "__segment")


def with_position(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    position: str = "position",
    size: str = "series_rows",
) -> DataFrame:
    """One-based position of each row in its series, and the rows in that series."""
    at = F.row_number().over(series_window(key, order)).cast("bigint")
    if not key:
        rows = df.count()
        total = F.lit(rows).cast("bigint")
        if rows <= series_row_limit(df.sparkSession):
            return df.withColumns({position: at, size: total})
        numbered = number_rows(df, order, position, rows)
        return numbered.withColumns({position: F.col(position) + 1, size: total})
    longer = long_series(df, key)
    count = F.count(F.lit(1)).over(Window.partitionBy(*key))
    if longer is None:
        return df.withColumns({position: at, size: count})
    short, long = set_apart(df, key, longer)
    short = short.withColumns({position: at, size: count})
    rows = number_rows(long, [*key, *order], "__row", longer.rows)
    spans = rows.groupBy(*key).agg(
        F.min("__row").alias("__first"), F.count(F.lit(1)).alias(size)
    )
    spanned = attach_by_key(rows, spans, key)
    split = spanned.withColumn(
        position, F.col("__row") - F.col("__first") + 1
    )
    return short.unionByName(split.drop("__row", "__first"))


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    totals: dict[str, str],
    longer: Known = UNKNOWN,
) -> DataFrame:
    """Running sums (``{new name: column}``) up to and including each row of its group."""

    def add(rows: DataFrame, window: WindowSpec) -> DataFrame:
        upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.withColumns({n: F.sum(c).over(upto) for n, c in totals.items()})

    if longer is UNKNOWN:
        longer = long_series(df, group)
    if longer is None:
        return add(df, series_window(group, order))
    # Sum inside range partitions, then add what the earlier partitions hold.
    short, long = set_apart(df, group, longer)
    ranges = long.repartitionByRange(ranges_for(df, longer.rows), *group, *order)
    rows = settle_table(ranges.withColumn("__part", F.spark_partition_id()))
    before = series_window(group, ["__part"]).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(*group, "__part")
        .agg(*[F.sum(c).alias(f"__c_{n}") for n, c in totals.items()])
        .withColumns(
            {f"__c_{n}": F.coalesce(F.sum(f"__c_{n}").over(before), F.lit(0)) for n in totals}
        )
    )
    local = add(rows, series_window([*group, "__part"], order))
    joined = attach_by_key(local, carried, [*group, "__part"])
    split = joined.withColumns({n: F.col(n) + F.col(f"__c_{n}") for n in totals}).drop(
        "__part", *[f"__c_{n}" for n in totals]
    )
    return add(short, series_window(group, order)).unionByName(split) if group else split


def value_counts(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """How often each value occurs in each group."""
    rows = present(df.select(*group, value), [value])
    return rows.groupBy(*group, value).agg(F.count(F.lit(1)).alias("n_rows"))


def quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    name: str = "quantiles",
    method: str = "exact",
    error: float = SKETCH_ERROR,
) -> DataFrame:
    """Quantiles per group, ``exact`` (:func:`exact_quantiles`) or by a ``sketch``.

    The sketch merges in any order, so a group of any size is one pass with map-side combine and
    some thousand values of memory. It returns values of the group, one whose rank is off by at
    most ``error`` times the group's rows for each probability.
    """
    if method == "exact":
        return exact_quantiles(df, group, value, probabilities, name)
    if method != "sketch":
        raise ValueError(f"method must be exact or sketch, got {method!r}")
    rows = present(df.select(*group, value), [value])
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    found = F.percentile_approx(value, wanted, F.lit(sketch_accuracy(error)))
    return rows.groupBy(*group).agg(found.alias(name))


def sketch_accuracy(error: float) -> int:
    if not 0 < error < 1:
        raise ValueError(f"error must be between 0 and 1, got {error!r}")
    return -int(-1 // error)


def exact_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    name: str = "quantiles",
) -> DataFrame:
    """Linearly interpolated quantiles per group, exact at any group size.

    Groups of up to ``QUANTILE_ROWS`` rows use the built-in aggregate, which holds a
    group's distinct values in memory; larger ones go through :func:`quantiles_of_counts`.
    """
    rows = present(df.select(*group, value), [value])
    at_once = F.percentile(value, F.array(*map(F.lit, probabilities))).alias(name)
    longer = long_series(rows, group, QUANTILE_ROWS)
    if longer is None:
        return rows.groupBy(*group).agg(at_once)
    short, long = set_apart(rows, group, longer)
    counts = settle_table(value_counts(long, group, value))
    split = quantiles_of_counts(counts, group, value, probabilities, name)
    return short.groupBy(*group).agg(at_once).unionByName(split) if group else split


def quantiles_of_counts(
    counts: DataFrame,
    group: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    name: str = "quantiles",
) -> DataFrame:
    """Quantiles from :func:`value_counts`.

    Groups with many distinct values look up the values at the wanted ranks in running
    counts instead of gathering the group.
    """
    longer = long_series(counts, group, QUANTILE_ROWS)
    if longer is None:
        wanted = F.array(*map(F.lit, probabilities))
        return counts.groupBy(*group).agg(
            F.percentile(value, wanted, F.col("n_rows")).alias(name)
        )
    through = running_totals(counts, group, [value], {"__through": "n_rows"}, longer)
    sizes = counts.groupBy(*group).agg(F.sum("n_rows").alias("__size"))
    if group:
        ranked = attach_by_key(through, sizes, group)
    else:
        ranked = through.withColumn("__size", F.lit(sizes.first()[0]))

    def quantile(p: float) -> Column:
        at = F.lit(float(p)) * (F.col("__size") - 1)

        def value_at(rank: Column) -> Column:
            first = F.col("__through") - F.col("n_rows")
            inside = (rank >= first) & (rank < F.col("__through"))
            return F.max(F.when(inside, F.col(value)))

        low, share = value_at(F.floor(at)), F.max(at - F.floor(at))
        return low + (value_at(F.ceil(at)) - low) * share

    return ranked.groupBy(*group).agg(F.array(*map(quantile, probabilities)).alias(name))
