from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lagline.functions.clean import (
    calendar,
    epoch_micros,
    instant_to_utc,
    normal_label,
    parse_number,
    parse_time,
    standard_rows,
    step_interval,
    unread_times,
    utc_to_instant,
)
from lagline.functions.history import mean_before_newest, push, recur

NOON = datetime(2024, 3, 10, 12)


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x"), df.schema["x"].dataType)).collect()]


def test_parse_time_text(spark):
    texts = ["2024-03-10 12:00:00", "2024-03-10T12:00:00Z", "2024-03-10T07:00:00-05:00", "no", None]
    assert column(spark, texts, "string", parse_time) == [NOON, NOON, NOON, None, None]


def test_parse_time_date_text_is_midnight(spark):
    assert column(spark, ["2024-03-10"], "string", parse_time) == [datetime(2024, 3, 10)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-03-10 12:00:00+04", datetime(2024, 3, 10, 8)),
        ("2024-03-10 12:00:00 +0400", datetime(2024, 3, 10, 8)),
        ("2024-03-10T12:00:00.25-03:30", datetime(2024, 3, 10, 15, 30, 0, 250_000)),
        ("2024/03/10 12:00:00+00", NOON),
        ("2024/3/10", datetime(2024, 3, 10)),
        ("20240310", datetime(2024, 3, 10)),
        ("20240310 12:00", NOON),
        ("03/10/2024 12:00", NOON),
        ("13/02/2024", datetime(2024, 2, 13)),
        ("2024-03-10 12:00 utc", NOON),
        ("\t2024-03-10 12:00:00Z\n", NOON),
        ("2024-03", datetime(2024, 3, 1)),
        ("2024", datetime(2024, 1, 1)),
        ("2024-03-10+04", None),
        ("2024-03-10 12:00:00 EST", None),
        ("2024-03-10 12:00:00 Indian/Reunion", None),
        ("2024-13-10", None),
        ("2024-02-30", None),
        ("25:00", None),
        ("", None),
    ],
)
def test_parse_time_layouts(spark, text, expected):
    assert column(spark, [text], "string", parse_time) == [expected]


def test_unread_times_are_counted(spark):
    rows = [("2024-01-01", "x"), ("no", None), (None, "2024"), ("nor this", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert tuple(unread_times(df, ["a", "b"]).first()) == (2, 2)


def test_parse_time_nanoseconds(spark):
    exact = NOON.replace(microsecond=123_457)
    assert column(spark, [1_710_072_000_123_457_000], "bigint", parse_time) == [exact]
    times = [1.710072e18, float("nan"), None]
    assert column(spark, times, "double", parse_time) == [NOON, None, None]


def test_parse_time_other_types(spark):
    assert column(spark, [NOON.date()], "date", parse_time) == [datetime(2024, 3, 10)]
    assert column(spark, [True], "boolean", parse_time) == [None]


@pytest.mark.parametrize("zone", ["UTC", "America/Toronto"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "SELECT timestamp_ntz'2024-03-10 02:30:00' AS t, "
            "'2024-03-10T02:30:00Z' AS z, '2024-03-10 02:30:00' AS plain"
        )
        row = df.select(
            instant_to_utc(utc_to_instant(F.col("t"))),
            epoch_micros(F.col("t")),
            parse_time(F.col("z"), df.schema["z"].dataType),
            parse_time(F.col("plain"), df.schema["plain"].dataType),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    time = datetime(2024, 3, 10, 2, 30)
    assert list(row) == [time, 1_710_037_800_000_000, time, time]


def test_parse_number_text(spark):
    assert column(spark, ["\t5", "6\n"], "string", parse_number) == [5.0, 6.0]
    texts = ["1.5", " 2 ", "-3e2", ".5", "7.", "1d", "1,5", "0x1", "", "nan", "inf", None]
    found = column(spark, texts, "string", parse_number)
    assert found[:5] == [1.5, 2.0, -300.0, 0.5, 7.0]
    assert found[5:10] == [None] * 5
    assert found[10:] == [float("inf"), None]


def test_parse_number_folds_nan(spark):
    assert column(spark, [1.0, float("nan"), None], "double", parse_number) == [1.0, None, None]


def test_standard_rows_drops_what_cannot_be_read(spark):
    df = spark.createDataFrame(
        [("2024-03-10 12:00:00", "4"), ("never", "4"), ("2024-03-10 12:00:00", "x")],
        "datetime string, value string",
    )
    assert [tuple(r) for r in standard_rows(df).collect()] == [(NOON, 4.0)]


def test_normal_label(spark):
    texts = ["PM2,5", " pm2,5\t", "Pm2,5", "no2", None]
    found = column(spark, texts, "string", lambda c, _: normal_label(c))
    assert found == ["PM2.5", "PM2.5", "PM2,5", "NO2", None]


def test_calendar_week_starts_on_monday(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 05:00:00' AS t")  # a Monday
    assert list(df.select(*calendar(F.col("t")).values()).first()) == [5, 0, 1]


def test_step_interval(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-10 12:00:00' AS t")
    row = df.select(
        F.col("t") + step_interval("D", F.lit(2)), F.col("t") + step_interval("h", F.lit(2))
    ).first()
    assert list(row) == [datetime(2024, 3, 12, 12), datetime(2024, 3, 10, 14)]
    with pytest.raises(ValueError):
        step_interval("M", F.lit(1))


def test_history_expressions(spark):
    df = spark.createDataFrame(
        [([1.0, 2.0, 3.0, 4.0],), ([5.0],)], "h array<double>"
    )
    h = F.col("h")
    first, second = df.select(
        mean_before_newest(h, 2).alias("two"),
        mean_before_newest(h, 9).alias("all"),
        push(h, F.lit(7.0), 3).alias("pushed"),
    ).collect()
    assert (first["two"], first["all"], first["pushed"]) == (2.5, 2.0, [3.0, 4.0, 7.0])
    assert second["two"] != second["two"] and second["pushed"] == [5.0, 7.0]


def test_recur_feeds_predictions_back(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "h array<double>")
    made = df.select(recur(F.col("h"), [0.5, 2.0], 1.0, 3)).first()[0]
    assert made == [8.0, 18.5, 42.0]  # 0.5*2+2*3+1, 0.5*3+2*8+1, 0.5*8+2*18.5+1
