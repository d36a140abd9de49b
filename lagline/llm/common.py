"""Helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline.session import settle_table

#: Rows handed to a task function at once.
SLICE_ROWS = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def content_key(text: Column) -> Column:
    """128 bits that stand for a whole text; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def whole_text(text: str) -> Column:
    return F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unused(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have, in whatever case."""
    known = {c.lower() for c in frame.columns}
    while name.lower() in known:
        name += "_"
    return name


def map_texts(
    frame: DataFrame,
    text: str,
    fields: Sequence[tuple[str, str, pa.DataType]],
    start: Callable[[], Callable[[list], list]],
) -> DataFrame:
    """Replace the column ``text`` by new columns computed from it.

    ``fields`` are the new columns as (name, SQL type, Arrow type). ``start`` runs once in each
    task and returns a function from a list of texts (nulls included) to one list per field.
    Rows pass through in small slices, so a task holds few texts at a time.
    """
    kept = [f for f in frame.schema.fields if f.name != text]
    schema = ", ".join(
        [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in kept]
        + [f"{quoted(name)} {kind}" for name, kind, _ in fields]
    )
    names = [f.name for f in kept] + [name for name, _, _ in fields]
    kinds = [kind for _, _, kind in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            place = batch.schema.get_field_index(text)
            others = [i for i in range(batch.num_columns) if i != place]
            for first in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(first, SLICE_ROWS)
                made = work(part.column(place).to_pylist())
                arrays = [part.column(i) for i in others]
                arrays += [pa.array(v, kind) for v, kind in zip(made, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return frame.mapInArrow(run, schema)


def map_batches(
    frame: DataFrame, schema: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator]
) -> DataFrame:
    return frame.mapInArrow(work, schema)


def smallest_hashes(frame: DataFrame, column: str, most: int, total: int) -> DataFrame:
    """The ``most`` rows with the smallest hashes of a column; ``total`` is the number of rows.

    The hash is cut off first where four times as many rows are to be expected, so that what the
    tasks send on does not grow with their number.
    """
    place = F.shiftrightunsigned(F.xxhash64(column), 33)
    below = min(1 << 31, (4 * most + 1000) * (1 << 31) // max(total, 1))
    return frame.where(place < below).orderBy(place, column).limit(most)


def settled(frame: DataFrame) -> DataFrame:
    """A table in the shared folder that later steps read again, column by column."""
    return settle_table(frame)
