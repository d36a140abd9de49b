"""Unpivot, union and distinct listings."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.functions.clean import present, quoted, with_numbers


def union_tables(tables: Iterable[DataFrame]) -> DataFrame:
    """All rows of all tables by column name; a column a table lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def wide_to_long(
    df: DataFrame,
    ids: Sequence[str],
    measures: Sequence[str],
    name: str = "pollutant",
    value: str = "value",
) -> DataFrame:
    """One row per id row and measure, keeping null cells."""
    numbers = with_numbers(df, measures)
    return numbers.unpivot([*map(quoted, ids)], [*map(quoted, measures)], name, value)


def station_names(df: DataFrame) -> DataFrame:
    """Distinct texts of every column whose name contains ``station``, sorted."""
    columns = [c for c in df.columns if "station" in c.lower()]
    if not columns:
        return df.sparkSession.createDataFrame([], "station string")
    cells = F.array(*[F.col(quoted(c)).cast("string") for c in columns])
    listed = df.select(F.explode(cells).alias("station"))
    return present(listed, ["station"]).distinct().orderBy("station")
