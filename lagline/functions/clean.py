"""Parsing and cleaning of single columns.

A time is kept as ``timestamp_ntz`` holding the UTC wall clock, so no result depends on
the session time zone.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns and replacements that must be as they are for right results.
# Layouts of times. A date is year, month, day with - or /, or eight digits, or month/day/year (day
# first if the first number cannot be a month); without a clock also year and month, or a year.
# A clock is hours and minutes, or more, after T or blanks; a zone needs a clock.
YEAR_FIRST = r"(\d{4})([-/])(\d{1,2})\2(\d{1,2})"
COMPACT = r"(\d{4})(\d\d)(\d\d)"
DAY_FIRST = r"(1[3-9]|[23]\d)/(\d{1,2})/(\d{4})"
MONTH_FIRST = r"(\d{1,2})/(\d{1,2})/(\d{4})"
CLOCK = r"(?:[tT]|\s+)(\d{1,2}:\d\d(?::\d\d(?:\.\d+)?)?)"
ZONE = r"\s*(?:[zZ]|[uU][tT][cC]|[gG][mM][tT]|([+-](?:0\d|1[0-7]|18(?!:?[0-5]?[1-9])))(?::?([0-5]\d))?)"
DATE_ALONE = r"(\d{4})(?:-(\d{1,2}))?"
TIME_TEXT = (
    f"^(?:(?:{YEAR_FIRST}|{COMPACT}|{DAY_FIRST}|{MONTH_FIRST})(?:{CLOCK}(?:{ZONE})?)?"
    f"|{DATE_ALONE})$"
)
# The same text as " year-month-day clock|zone hours:minutes".
TIME_PARTS = " $1$5$10$13$17-$3$6$9$11$18-$4$7$8$12 $14|$15:$16"
BLANKS = " \t\n\x0b\f\r"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INFINITE = r"^[+-]?(?i:inf|infinity)$"
LABEL_REPLACEMENTS = {"PM2,5": "PM2.5", "pm2,5": "PM2.5"}
STD_FLOOR = 1e-8

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def instant_to_utc(instant: Column) -> Column:
    """Zoned instant to UTC wall clock, whatever the session zone."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000)).cast(
        "decimal(18,6)"
    )
    zero = F.lit(0)
    return F.expr(_EPOCH) + F.make_dt_interval(zero, zero, zero, seconds)


def utc_to_instant(time: Column) -> Column:
    """UTC wall clock to zoned instant."""
    return F.timestamp_micros(epoch_micros(time))


def epoch_micros(time: Column) -> Column:
    """Microseconds since 1970 of a UTC wall clock."""
    day = F.unix_date(time.cast("date")).cast("bigint") * 86_400
    clock = F.hour(time) * 3_600 + F.minute(time) * 60
    second = F.extract(F.lit("SECOND"), time).cast("decimal(18,6)")
    return (day + clock) * 1_000_000 + (second * 1_000_000).cast("bigint")


def parse_time(column: Column, kind: T.DataType) -> Column:
    """Any time-like column to UTC wall clock; what cannot be read becomes null.

    Text is read in the layouts of ``TIME_TEXT``; anything else, such as an unknown zone,
    becomes null (see :func:`unread_times`). Text without a zone is taken as UTC, numbers
    as nanoseconds since 1970. For text in many rows see :func:`with_times`.
    """
    if isinstance(kind, T.TimestampNTZType):
        return column
    if isinstance(kind, T.TimestampType):
        return instant_to_utc(column)
    if isinstance(kind, T.StringType):
        return time_of_parts(time_parts(column))
    if isinstance(kind, T.DateType):
        return column.cast("timestamp_ntz")
    if isinstance(kind, T.NumericType):
        micros = F.call_function("div", column.try_cast("bigint"), F.lit(1_000))
        return instant_to_utc(F.timestamp_micros(micros))
    return F.lit(None).cast("timestamp_ntz")


def time_parts(text: Column) -> Column:
    """``TIME_PARTS`` of a text that is a time; another text does not begin with a blank."""
    return F.regexp_replace(F.btrim(text, F.lit(BLANKS)), TIME_TEXT, TIME_PARTS)


def time_of_parts(parts: Column) -> Column:
    """The wall clock in UTC of what :func:`time_parts` returns."""
    wall = F.rtrim(F.substring_index(parts, "|", 1), F.lit(" -")).try_cast("timestamp_ntz")
    zone = F.substring_index(parts, "|", -1)  # hours:minutes, or only the colon
    minutes = F.when(F.length(zone) == 6, F.substring(zone, 5, 2).cast("int")).otherwise(0)
    sign = F.when(F.startswith(zone, F.lit("-")), -1).otherwise(1)
    ahead = F.make_dt_interval(F.lit(0), F.substring(zone, 1, 3).cast("int"), sign * minutes)
    moved = F.when(F.length(zone) == 1, wall).otherwise(wall - ahead)
    return F.when(F.startswith(parts, F.lit(" ")), moved)


def unread_times(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """One row: how many cells of each column hold something that is not read as a time."""
    names = list(names)
    was = [F.col(quoted(n)).alias(f"__was{i}") for i, n in enumerate(names)]
    read = with_times(df.select(*was, *map(quoted, names)), names)
    lost = [
        F.count_if(F.col(f"__was{i}").isNotNull() & F.col(quoted(n)).isNull()).alias(n)
        for i, n in enumerate(names)
    ]
    return read.agg(*lost)


def parse_number(column: Column, kind: T.DataType) -> Column:
    """Any column to double; what is not a number becomes null."""
    if isinstance(kind, T.StringType):
        text = F.btrim(column, F.lit(BLANKS))
        usable = text.rlike(NUMBER) | text.rlike(INFINITE)
        return F.when(usable, text.try_cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        number = column.cast("double")
        return F.when(~F.isnan(number), number)
    return F.lit(None).cast("double")


def quoted(name: str) -> str:
    """A column name as it must be written where Spark would split it at a dot."""
    return "`" + name.replace("`", "``") + "`"


def with_times(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Columns as times, in place. A text is read once, also if a later filter asks for it."""
    kinds = {n: df.schema[n].dataType for n in names}
    times = {n: parse_time(F.col(quoted(n)), k) for n, k in kinds.items()}
    rows = df
    for i, n in enumerate(kinds):
        if isinstance(kinds[n], T.StringType):
            rows = bound(rows, f"__parts{i}", time_parts(F.col(quoted(n))))
            rows = bound(rows, f"__time{i}", time_of_parts(F.col(f"__parts{i}")))
            times[n] = F.col(f"__time{i}")
    return rows.select(*[times.get(c, F.col(quoted(c))).alias(c) for c in df.columns])


def bound(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a column that is worked out once per row; filters on it do not move below."""
    return df.select("*", F.explode(F.array(column)).alias(name))


def with_numbers(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns(
        {n: parse_number(F.col(quoted(n)), df.schema[n].dataType) for n in names}
    )


def present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rows with neither null nor NaN in the named columns; unlike ``na.drop`` the filter
    reaches a scan."""

    def has_value(name: str) -> Column:
        column = F.col(quoted(name))
        if isinstance(df.schema[name].dataType, T.FractionalType):
            return column.isNotNull() & ~F.isnan(column)
        return column.isNotNull()

    return df.where(reduce(Column.__and__, map(has_value, names), F.lit(True)))


def standard_rows(df: DataFrame, time: str = "datetime", value: str = "value") -> DataFrame:
    """Parse time and value and keep the rows that have both."""
    return present(with_numbers(with_times(df, [time]), [value]), [time, value])


def normal_label(label: Column) -> Column:
    """Trimmed, upper-case label with the decimal comma repaired."""
    text = F.btrim(label.cast("string"), F.lit(BLANKS))
    for old, new in LABEL_REPLACEMENTS.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.upper(text)


def calendar(time: Column, hour: bool = True) -> dict[str, Column]:
    """Hour, day of week (Monday = 0) and month."""
    fields = {"hour": F.hour(time)} if hour else {}
    return {**fields, "dow": F.weekday(time), "month": F.month(time)}


def zscore(value: Column, mean: Column, std: Column) -> Column:
    return (value - mean) / std


def from_zscore(z: Column, mean: Column, std: Column) -> Column:
    return z * std + mean


def step_interval(freq: str, steps: Column) -> Column:
    """``steps`` days (``D``) or hours (``H``) as an interval."""
    steps = steps.cast("int")
    if freq.upper() == "H":
        return F.make_dt_interval(F.lit(0), steps)
    if freq.upper() == "D":
        return F.make_dt_interval(steps)
    raise ValueError(f"freq must be D or H, got {freq!r}")
