"""Row selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagline.functions.clean import normal_label
from lagline.operators.series import broadcast_if_short, match_keys, with_position
from lagline.session import settle

GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def only_pollutant(df: DataFrame, pollutant: str | None) -> DataFrame:
    """Exact match, when there is a label to match and a column to match it in."""
    if pollutant and "pollutant" in df.columns:
        return df.where(F.col("pollutant") == pollutant)
    return df


def only_normal_pollutant(df: DataFrame, pollutant: str) -> DataFrame:
    """Match after normalising both sides; the column must exist."""
    if "pollutant" not in df.columns:
        raise ValueError("the table has no pollutant column; name the one to use")
    return df.where(normal_label(F.col("pollutant")) == normal_label(F.lit(pollutant)))


def matching_text(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text contains the pattern in any case, accented letters included; null
    never matches."""
    found = F.col(column).cast("string").rlike(f"(?iu){pattern}")
    return df.where(F.coalesce(found, F.lit(False)))


def history_tail(
    df: DataFrame, key: Sequence[str], rows: int, order: Sequence[str] = ("datetime",)
) -> DataFrame:
    """The last ``rows`` rows of each series.

    Spark applies the rank limit before the shuffle too, so a long series sends at most
    ``rows`` rows per input partition. It does so up to a threshold; a longer tail is
    taken by position.
    """
    if not key:
        return df.orderBy(*[F.desc(c) for c in order]).limit(rows)
    if rows > int(df.sparkSession.conf.get(GROUP_LIMIT, "1000")):
        placed = with_position(df, key, order, "__position", "__size")
        tail = placed.where(F.col("__position") > F.col("__size") - rows)
        return tail.drop("__position", "__size")
    latest = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order])
    ranked = df.withColumn("__rank", F.row_number().over(latest))
    return ranked.where(F.col("__rank") <= rows).drop("__rank")


def by_history_length(
    df: DataFrame, key: Sequence[str], rows: int
) -> tuple[DataFrame, DataFrame]:
    """(rows of series with at least ``rows`` rows, the shorter series and their sizes)."""
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("history_rows"))
    short = settle(sizes.where(F.col("history_rows") < rows))
    if not key:
        return (df if short.isEmpty() else df.limit(0)), short
    return match_keys(df, broadcast_if_short(short.select(*key)), key, "left_anti"), short
