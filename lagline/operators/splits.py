"""Ordered splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagline.operators.series import attach_by_key, match_keys, sketch_accuracy, with_position
from lagline.session import settle

# Rows of the recent window and the size up to which halves are taken.
RECENT_ROWS = 30
HALVES_UPTO = 60

#: Shares of a series, as powers of a half, from which its newest rows may be looked for, and
#: the error of those shares' ranks.
SHARES, RANK_ERROR = 13, 0.0001


def holdout(
    df: DataFrame,
    order: Sequence[str],
    key: Sequence[str] = (),
    share: float = 0.2,
    name: str = "slice",
) -> DataFrame:
    """Label the first ``1 - share`` of the rows ``train`` and the rest ``validation``.

    With an empty key the whole table is one order, otherwise each series has its own.
    """
    rows = with_position(df, key, order, "__position", "__size")
    train = F.col("__position") <= F.floor(F.col("__size") * F.lit(1 - share))
    label = F.when(train, "train").otherwise("validation")
    return rows.withColumn(name, label).drop("__position", "__size")


def recent_split(
    df: DataFrame,
    order: Sequence[str],
    key: Sequence[str] = (),
    name: str = "slice",
    recent_rows: int = RECENT_ROWS,
    halves_upto: int = HALVES_UPTO,
) -> DataFrame:
    """Label the recent rows of each series ``current`` and the earlier ``reference``.

    Series of up to ``halves_upto`` rows are halved; of longer ones the last
    ``recent_rows`` are current.

    No series is sorted. A mergeable sketch of the first order column bounds the share of a long
    series that holds its newest rows; these few are ranked, and the oldest current row is the
    cut that every row is compared with. Equal rows at the cut are numbered.
    """
    if not key:
        whole = df.withColumn("__all", F.lit(0))
        return recent_split(whole, order, ["__all"], name, recent_rows, halves_upto).drop("__all")
    size, row = F.col("__size"), F.struct(*order)
    shares = range(1, SHARES + 1)
    probabilities = F.array(*[F.lit(1 - 0.5**j) for j in shares])
    sketch = F.percentile_approx(order[0], probabilities, F.lit(sketch_accuracy(RANK_ERROR)))
    sizes = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("__size"), F.count(order[0]).alias("__known"), sketch.alias("__at")
    )
    # The smallest share that holds the recent rows, whatever the error of its rank.
    held = [F.col("__known") * (0.5**j - RANK_ERROR) > recent_rows for j in shares]
    place = reduce(Column.__add__, [F.when(h, 1).otherwise(0) for h in held])
    halves = size <= halves_upto
    bounds = sizes.select(
        *key,
        F.when(halves, size - F.floor(size / 2)).otherwise(recent_rows).alias("__current"),
        F.when(~halves & (place > 0), F.get("__at", place - 1)).alias("__from"),
    )
    near = attach_by_key(df.select(*key, *order), bounds, key)
    near = near.where(F.col("__from").isNull() | (F.col(order[0]) >= F.col("__from")))
    near = settle(near.drop("__from"))
    newest = Window.partitionBy(*key).orderBy(*[F.desc_nulls_last(o) for o in order])
    ranked = near.withColumn("__rank", F.row_number().over(newest))
    ranked = ranked.where(F.col("__rank") <= max(recent_rows, halves_upto - halves_upto // 2))
    ranked = ranked.where(F.col("__rank") <= F.col("__current"))
    cuts = settle(ranked.groupBy(*key).agg(F.min(row).alias("__cut")))
    equal = attach_by_key(near, cuts, key).where(row == F.col("__cut"))
    ties = equal.groupBy(*key).agg(F.count(F.lit(1)).alias("__equal"))
    above = attach_by_key(ranked, cuts, key).where(row > F.col("__cut"))
    above = above.groupBy(*key).agg(F.count(F.lit(1)).alias("__above"))
    room = F.col("__current") - F.coalesce("__above", F.lit(0))
    cuts = match_keys(match_keys(cuts, ties, key, "left"), above, key, "left")
    cuts = match_keys(cuts, bounds.select(*key, "__current"), key, "left")
    cuts = settle(cuts.select(*key, "__cut", "__equal", room.alias("__room")))
    labelled = attach_by_key(df, cuts, key, "left")
    is_current = row >= F.col("__cut")
    if not cuts.where("__equal > __room").isEmpty():
        # Only so many of the rows that are equal to the cut are current.
        at_cut = row == F.col("__cut")
        tied = labelled.where(at_cut)
        number = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
        tied = tied.withColumn("__number", number)
        labelled = labelled.where(F.coalesce(~at_cut, F.lit(True)))
        labelled = labelled.withColumn("__number", F.lit(0)).unionByName(tied)
        is_current = is_current & (F.col("__number") <= F.col("__room"))
        labelled = labelled.withColumn("__current", is_current).drop("__number")
    else:
        labelled = labelled.withColumn("__current", is_current)
    label = F.when(F.col("__current"), "current").otherwise("reference")
    return labelled.withColumn(name, label).drop("__cut", "__equal", "__room", "__current")
