from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lagline.operators.windows import is_daily, median_gap, sequences
from lagline.plans.features import (
    DAILY_LAGS,
    HOURLY_LAGS,
    daily_features,
    featurise_files,
    hourly_features,
)

START = datetime(2024, 1, 1)


def series(spark, n, step=timedelta(hours=1), value=float, station=1, pollutant="NO2"):
    rows = [(START + i * step, station, pollutant, value(i)) for i in range(n)]
    return spark.createDataFrame(
        rows, "datetime timestamp_ntz, station_id int, pollutant string, value double"
    )


def weather(spark, hours):
    rows = [(START + timedelta(hours=h), 0.0) for h in hours]
    return spark.createDataFrame(rows, "datetime timestamp_ntz, temp double")


def test_hourly_features_by_hand(spark):
    table = hourly_features(series(spark, 30), weather(spark, range(30)), pollutant="NO2")
    rows = table.frame.orderBy("datetime").collect()
    assert [r["value"] for r in rows] == [24.0, 25.0, 26.0, 27.0, 28.0]
    for row in rows:
        i = row["value"]
        assert [row[f"lag_{n}"] for n in HOURLY_LAGS] == [i - n for n in HOURLY_LAGS]
        assert row["roll_24"] == i - 12.5 and row["target"] == i + 1
        assert (row["hour"], row["dow"], row["month"]) == (int(i) % 24, int(i) // 24, 1)
    assert set(table.features) == {
        "temp", "roll_24", "hour", "dow", "month", *(f"lag_{n}" for n in HOURLY_LAGS)
    }


def test_too_few_rows_give_none(spark):
    assert hourly_features(series(spark, 10)).frame.count() == 0


def test_weather_names_with_dots_and_nan(spark):
    odd = weather(spark, range(30)).withColumn(
        "wind.speed", F.when(F.hour("datetime") == 2, float("nan")).otherwise(1.0)
    )
    table = hourly_features(series(spark, 30), odd)
    assert "wind.speed" in table.features
    assert sorted(r["value"] for r in table.frame.collect()) == [24.0, 25.0, 27.0, 28.0]


def test_weather_gaps_do_not_shift_lags(spark):
    hours = [h for h in range(40) if h % 2 == 0]
    table = hourly_features(series(spark, 40), weather(spark, hours), lags=(1, 2))
    rows = table.frame.orderBy("datetime").collect()
    assert [r["value"] for r in rows] == [float(h) for h in range(24, 39, 2)]
    assert all(r["lag_1"] == r["value"] - 1 for r in rows)


def test_empty_weather_is_left_out(spark):
    assert hourly_features(series(spark, 30), weather(spark, [])).frame.count() == 5


def test_weather_columns_may_not_repeat(spark):
    with pytest.raises(ValueError):
        hourly_features(series(spark, 3), series(spark, 3))


def test_pollutants_are_separate_series(spark):
    both = series(spark, 30).union(series(spark, 30, value=lambda i: 100.0 + i, pollutant="O3"))
    rows = hourly_features(both).frame.collect()
    assert len(rows) == 10
    assert all(r["lag_1"] == r["value"] - 1 for r in rows)
    pooled = hourly_features(both, key=[]).frame
    assert pooled.where("abs(lag_1 - value) > 2").count() > 0


def test_daily_cadence_uses_a_week(spark):
    table = hourly_features(series(spark, 30, timedelta(days=1)))
    assert "roll_7" in table.features and "roll_24" not in table.features


def test_cadence_is_taken_inside_series(spark):
    far = series(spark, 3).union(
        series(spark, 3, station=2).withColumn(
            "datetime", F.expr("datetime + interval '900' day")
        )
    )
    assert median_gap(far, ["station_id"]).first()[0] == 3600.0
    assert not is_daily(series(spark, 1), ["station_id"])


def test_alias_columns(spark):
    renamed = series(spark, 30).withColumnsRenamed({"datetime": "Date", "value": "Valeur"})
    assert hourly_features(renamed).frame.count() == 5


def test_daily_features_against_pandas(spark):
    rng = np.random.default_rng(7)
    days = [START + timedelta(days=i) for i in range(40)]
    pdf = pd.DataFrame(
        {
            "jour": days * 3,
            "nom_station": np.repeat(["a", "b", "c"], 40),
            "iqa": rng.normal(50, 10, 120).round(3),
            "wind": rng.normal(5, 1, 120).round(3),
        }
    )
    table = daily_features(spark.createDataFrame(pdf))
    found = table.frame.toPandas().sort_values(["nom_station", "datetime"]).reset_index(drop=True)

    groups = pdf.groupby("nom_station")["iqa"]
    for n in DAILY_LAGS:
        pdf[f"lag_{n}"] = groups.shift(n)
    pdf["roll_7"] = groups.transform(lambda s: s.shift(1).rolling(7).mean())
    pdf["target"] = groups.shift(-1)
    wanted = pdf.dropna().reset_index(drop=True)
    assert len(found) == len(wanted) == 3 * 25
    for name in [*(f"lag_{n}" for n in DAILY_LAGS), "roll_7", "target", "wind"]:
        np.testing.assert_allclose(found[name], wanted[name])
    assert "hour" not in found and "wind" in table.features
    assert "nom_station" not in table.features


@pytest.mark.parametrize("limit", ["1000000", "25"])
def test_missing_values_against_pandas(spark, limit):
    """A row without a value keeps its place in the series but spoils what covers it."""
    rng = np.random.default_rng(3)
    sizes = {"a": 130, "b": 40, "c": 20}
    pdf = pd.concat(
        pd.DataFrame(
            {
                "datetime": START + pd.to_timedelta(np.sort(rng.choice(400, n, False)), "h"),
                "station_name": name,
                "value": np.where(rng.random(n) < 0.03, np.nan, rng.normal(0, 1, n)),
            }
        )
        for name, n in sizes.items()
    ).reset_index(drop=True)
    spark.conf.set("spark.lagline.maxSeriesRows", limit)
    try:
        frame = hourly_features(spark.createDataFrame(pdf)).frame.toPandas()
    finally:
        spark.conf.unset("spark.lagline.maxSeriesRows")
    groups = pdf.groupby("station_name")["value"]
    for n in HOURLY_LAGS:
        pdf[f"lag_{n}"] = groups.shift(n)
    pdf["roll_24"] = groups.transform(lambda s: s.shift(1).rolling(24).mean())
    pdf["target"] = groups.shift(-1)
    wanted = pdf.dropna().reset_index(drop=True)
    order = ["station_name", "datetime"]
    found = frame.sort_values(order)[wanted.columns].reset_index(drop=True)
    assert 0 < len(wanted) < 120
    pd.testing.assert_frame_equal(found, wanted, check_dtype=False)


def test_daily_features_strict(spark):
    days = series(spark, 20, timedelta(days=1)).withColumn(
        "note", F.when(F.col("value") != 15, "kept")
    )
    assert daily_features(days).frame.count() == 5
    assert daily_features(days, strict=True).frame.count() == 4


def test_sequences(spark):
    rows = sequences(series(spark, 5), ["station_id"], ["datetime"], "value", 3).collect()
    assert sorted(r["sequence"] for r in rows) == [[0.0, 1.0, 2.0], [1.0, 2.0, 3.0]]


def test_long_series_split(spark, tiny_tasks):
    table = hourly_features(series(spark, 200), pollutant="NO2")
    rows = table.frame.orderBy("datetime").collect()
    assert [r["value"] for r in rows] == [float(i) for i in range(24, 199)]
    assert all(r["lag_24"] == r["value"] - 24 and r["roll_24"] == r["value"] - 12.5 for r in rows)


def test_featurise_files(spark, tmp_path):
    rows = series(spark, 60).withColumn("station_name", F.lit("Saint-Denis 1"))
    other = series(spark, 60, station=2).withColumn("station_name", F.lit("elsewhere"))
    rows.where("value < 30").write.parquet(f"{tmp_path}/a")
    rows.where("value >= 30").unionByName(other).write.parquet(f"{tmp_path}/b")
    table = featurise_files(spark, [f"{tmp_path}/a", f"{tmp_path}/b"], f"{tmp_path}/out")
    assert table.frame.count() == 35
    assert [r[0] for r in table.frame.select("station_name").distinct().collect()] == [
        "Saint-Denis 1"
    ]


def test_filter_reaches_the_scan(spark, tmp_path):
    series(spark, 5).write.parquet(f"{tmp_path}/t")
    table = hourly_features(spark.read.parquet(f"{tmp_path}/t"), pollutant="NO2", daily=False)
    plan = table.frame._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(pollutant,NO2)" in plan
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Window [") == 1


@pytest.mark.parametrize(
    ("hours", "daily"),
    [
        ([], False),
        ([24], True),
        ([23], False),
        ([1, 24], False),
        ([22, 26], True),
        ([1, 47], True),
        ([1, 1, 30], False),
        ([1, 30, 30], True),
        ([0, 0, 0, 48, 48], False),
        ([0, 0, 24, 48], False),
    ],
)
def test_cadence_from_counts_is_that_of_the_median(spark, hours, daily):
    times = [START]
    for h in hours:
        times.append(times[-1] + timedelta(hours=h))
    rows = spark.createDataFrame([(t,) for t in times], "datetime timestamp_ntz")
    median = median_gap(rows, []).first()[0]
    assert is_daily(rows, []) == daily == (median is not None and median >= 86_400)
