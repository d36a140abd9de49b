from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lagline.operators.reshape import station_names, union_tables
from lagline.sources.columns import (
    daily_value_column,
    hourly_layout,
    lags_in,
    name_history_columns,
    rename_first,
    scoring_columns,
    search_column,
    with_series_key,
)
from lagline.sources.sinks import log_run, read_runs, write_json_records
from lagline.sources.tables import (
    default_paths,
    land_csv,
    load_daily,
    load_hourly,
    load_predictions,
    load_training,
    preview,
    read_tables,
)

DAY = datetime(2024, 1, 1)


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_search_column_prefers_name_then_alias_then_part():
    columns = ["my_date", "TimeStamp", "datetime2"]
    assert search_column(columns, "datetime2", ["timestamp"], ["date"]) == "datetime2"
    assert search_column(columns, "absent", ["datetime", "timestamp"], ["date"]) == "TimeStamp"
    assert search_column(columns, None, ["datetime"], ["date"]) == "my_date"
    assert search_column(columns, None, ["datetime"]) is None


def test_rename_first_keeps_an_existing_name(spark):
    df = frame(spark, "datetime string, Date string")
    assert rename_first(df, ["Date"], "datetime").columns == ["datetime", "Date"]


@pytest.mark.parametrize(
    "schema, expected",
    [
        ("Indice int, value int", "value"),
        ("my_IQA_mean string, n int", "my_IQA_mean"),
        ("iqa_a string, iqa_b string, label string, n int", "n"),
    ],
)
def test_daily_value_column(spark, schema, expected):
    assert daily_value_column(frame(spark, schema).schema) == expected


def test_daily_value_column_must_exist(spark):
    with pytest.raises(ValueError):
        daily_value_column(frame(spark, "a string").schema)


def test_series_key(spark):
    assert with_series_key(frame(spark, "station_id int, station_name string"))[1] == [
        "station_name"
    ]
    both = frame(spark, "pollutant string, code_station int")
    assert with_series_key(both)[1] == ["code_station", "pollutant"]
    alone, key = with_series_key(frame(spark, "value int", (1,)))
    assert key == ["_series_id"] and alone.first()["_series_id"] == "ALL"


def test_lags_in():
    assert lags_in(["lag_14", "lag_2", "xlag_3", "lag_x", "lag_2"]) == [2, 14]


def test_hourly_layout_wide_and_long(spark):
    wide = frame(
        spark,
        "Date string, poste int, no2 string, o3 double, note string, Station string",
        ("2024-01-01", 3, "5", None, "x", "A"),
        ("2024-01-02", 3, "bad", None, "y", "A"),
    )
    assert hourly_layout(wide) == ("Date", "Station", ["no2"])
    assert hourly_layout(frame(spark, "date_time string, value int")).measures == []
    with pytest.raises(ValueError):
        hourly_layout(frame(spark, "a int"))
    with pytest.raises(ValueError):
        hourly_layout(wide.select("Date", "note"))


def test_scoring_columns(spark):
    df = frame(spark, "datetime string, station_id int, pollutant string, value int, s string")
    assert scoring_columns(df, ["value"]) == ["value"]
    assert scoring_columns(df, ["value", "lag_1"]) == ["station_id", "value"]
    assert scoring_columns(df, None) == ["station_id", "value"]


def test_name_history_columns(spark):
    df = frame(spark, "date_time string, measurement int")
    assert name_history_columns(df).columns == ["datetime", "value"]
    with pytest.raises(ValueError):
        name_history_columns(frame(spark, "date string, x int"))


def test_read_tables_unions_what_exists(spark, tmp_path):
    frame(spark, "a int, b string", (1, "x")).write.parquet(f"{tmp_path}/one")
    frame(spark, "a double, c int", (2.5, 7)).write.parquet(f"{tmp_path}/two")
    paths = [f"{tmp_path}/{n}" for n in ("one", "none", "two")]
    found = read_tables(spark, paths).orderBy("a")
    assert found.columns == ["a", "b", "c"]
    assert [tuple(r) for r in found.collect()] == [(1.0, "x", None), (2.5, None, 7)]
    with pytest.raises(FileNotFoundError):
        read_tables(spark, [f"{tmp_path}/none"])


def test_default_paths():
    assert default_paths("/in/", "d") == [
        "/in/iqa_daily_2022_2024.parquet",
        "/in/iqa_daily_2025_2027.parquet",
    ]


def test_preview(spark):
    columns, rows = preview(spark.range(9))
    assert columns == ["id"] and rows.count() == 3


def test_load_training_and_daily(spark):
    exact = frame(spark, "Date string, Indice string", ("2024-01-01", "4"), ("x", "4"))
    assert [tuple(r) for r in load_training(exact).collect()] == [(DAY, 4.0)]
    loose = frame(spark, "The_Date string, mean_aqi string", ("2024-01-01", "4"))
    assert load_daily(loose).columns == ["datetime", "value"]


def test_load_hourly_wide(spark):
    wide = frame(
        spark,
        "date string, nom_station string, `pm2,5` string, no2 double",
        ("2024-01-01", "A", "3", 4.0),
        ("2024-01-01", "B", "bad", None),
    )
    rows = {tuple(r) for r in load_hourly(wide).collect()}
    assert rows == {(DAY, "A", "PM2.5", 3.0), (DAY, "A", "NO2", 4.0)}


def test_load_hourly_wide_with_dots(spark):
    wide = frame(spark, "date string, `PM2.5` double, `a.b note` string", ("2024-01-01", 3.0, "x"))
    assert [tuple(r) for r in load_hourly(wide).collect()] == [(DAY, "PM2.5", 3.0)]


def test_load_hourly_overrides(spark):
    long = frame(
        spark,
        "t string, date string, place string, what string, amount int",
        ("2024-01-01", "no", "A", "no2", 4),
    )
    names = {
        "datetime": "t",
        "station_name": "place",
        "pollutant": "what",
        "value": "amount",
        "other": "absent",
    }
    row = load_hourly(long, names).first()
    assert (row["datetime"], row["station_name"], row["pollutant"], row["value"]) == (
        DAY,
        "A",
        "NO2",
        4.0,
    )


def test_load_predictions(spark):
    good = frame(spark, "Valid_Date string, YHAT string", ("2024-01-01", "4"), ("x", "4"))
    assert [tuple(r) for r in load_predictions(good).collect()] == [(DAY, 4.0)]
    for bad in ("Valid_Date string", "pred int", "date string, time string, pred int"):
        with pytest.raises(ValueError):
            load_predictions(frame(spark, bad))


def test_union_and_station_names(spark):
    a = frame(spark, "station_id int, Station string", (1, "b"), (2, None))
    b = frame(spark, "station_id int", (1,))
    names = station_names(union_tables([a, b]))
    assert [r[0] for r in names.collect()] == ["1", "2", "b"]
    assert station_names(frame(spark, "x int", (1,))).count() == 0


def test_land_csv(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("date,value\n2024-01-01,4\n2024-01-02,x\n")
    landed = land_csv(
        spark, f"{tmp_path}/raw.csv", f"{tmp_path}/landed", "date string, value string"
    )
    assert landed.count() == 2 and standard_days(landed) == [(DAY, 4.0)]


def standard_days(df):
    return [tuple(r) for r in load_training(df).collect()]


def test_json_records(spark, tmp_path):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS datetime, 1.5D AS forecast")
    path = write_json_records(df, f"{tmp_path}/json")
    row = spark.read.json(path).first()
    assert (row["datetime"], row["forecast"]) == ("2024-01-01 00:00:00+00:00", 1.5)


def test_run_log_appends(spark, tmp_path):
    log = f"{tmp_path}/runs"
    ids = {
        log_run(spark, log, "train", {"model": "rf", "station": None}, {"mae": 1.5, "x": None}),
        log_run(spark, log, "forecast", {}, {}),
    }
    runs = read_runs(spark, log)
    assert {r["run_id"] for r in runs.collect()} == ids
    train = runs.where(F.col("kind") == "train").first()
    assert train["params"] == {"model": "rf", "station": ""}
    assert train["metrics"] == {"mae": 1.5, "x": None}
