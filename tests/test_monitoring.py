import random
from bisect import bisect
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagline.operators.drift import column_distances, column_drift
from lagline.operators.joins import align
from lagline.operators.series import exact_quantiles, quantiles, running_totals, with_position
from lagline.operators.splits import holdout, recent_split
from lagline.plans.monitoring import monitor, run_monitoring
from lagline.sources.sinks import read_runs

START = datetime(2024, 1, 1)


def truth_and_forecast(spark, values, forecasts):
    times = [START + timedelta(days=i) for i in range(max(len(values), len(forecasts)))]
    truth = spark.createDataFrame(
        [(t, float(v)) for t, v in zip(times, values)], "datetime timestamp_ntz, value double"
    )
    made = spark.createDataFrame(
        [(t, float(v)) for t, v in zip(times, forecasts)],
        "datetime timestamp_ntz, forecast double",
    )
    return truth, made


@pytest.mark.parametrize("n, reference", [(2, 1), (5, 2), (60, 30), (61, 31), (200, 170)])
def test_recent_split_sizes(spark, n, reference):
    truth, _ = truth_and_forecast(spark, range(n), [])
    rows = recent_split(truth, ["datetime"]).orderBy("datetime").collect()
    assert [r["slice"] for r in rows] == ["reference"] * reference + ["current"] * (n - reference)


@pytest.mark.parametrize("n", [0, 1, 5, 9, 10])
def test_holdout_sizes(spark, n):
    truth, _ = truth_and_forecast(spark, range(n), [])
    rows = holdout(truth, ["datetime"]).orderBy("datetime").collect()
    assert [r["slice"] for r in rows].count("train") == int(n * (1 - 0.2))


def test_nothing_in_common(spark, tmp_path):
    truth, made = truth_and_forecast(spark, [1.0], [1.0])
    made = made.selectExpr("datetime + interval '9' day AS datetime", "forecast")
    report = run_monitoring(spark, truth, made, f"{tmp_path}/log")
    row = report.summary.first()
    assert (row["n_points"], row["mae"], row["drift_score"], row["alert"]) == (0, None, 0.0, False)
    assert not (tmp_path / "log").exists()


def test_alert_needs_more_than_the_limit(spark):
    truth, made = truth_and_forecast(spark, [10.0] * 20, [25.0] * 20)
    row = monitor(truth, made).summary.first()
    assert (row["mae"], row["alert"]) == (15.0, False)
    assert monitor(truth, made, mae_limit=14.9).summary.first()["alert"]


def test_drift_alert(spark, tmp_path):
    values = [10.0 + i % 3 for i in range(40)] + [31.0 + i % 3 for i in range(30)]
    truth, made = truth_and_forecast(spark, values, values)
    report = run_monitoring(spark, truth, made, f"{tmp_path}/log", "lstm")
    row = report.summary.first()
    assert (row["n_points"], row["mae"], row["drift_score"]) == (70, 0.0, 21.0)
    assert row["dataset_drift"] and row["alert"]
    run = read_runs(spark, f"{tmp_path}/log").first()
    assert run["params"]["model"] == "lstm" and run["params"]["n_points"] == "70"
    assert run["metrics"]["alert_flag"] == 1.0 and run["metrics"]["drift_median_abs"] == 21.0
    assert report.quality().count() == 2
    assert report.errors().agg({"n_points": "sum"}).first()[0] == 70
    assert report.largest().agg({"n_points": "sum"}).first()[0] == 70


def test_align_multiplies_repeated_times(spark):
    truth, made = truth_and_forecast(spark, [1.0, 2.0], [1.0, 2.0])
    assert align(truth.union(truth), made, repeats=True).count() == 4


def numpy_distances(a, b):
    pooled = np.sort(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), pooled, "right") / len(a)
    fb = np.searchsorted(np.sort(b), pooled, "right") / len(b)
    apart = np.abs(fa - fb)
    return apart.max(), (apart[:-1] * np.diff(pooled)).sum()


@pytest.mark.parametrize("limit", ["1000000", "20"])
def test_distances_against_numpy(spark, limit):
    rng = np.random.default_rng(11)
    a, b = rng.normal(0, 1, 150).round(1), rng.normal(0.5, 2, 90).round(1)
    rows = [("s", "reference", float(v)) for v in a] + [("s", "current", float(v)) for v in b]
    labelled = spark.createDataFrame(rows, "station string, slice string, value double")
    spark.conf.set("spark.lagline.maxSeriesRows", limit)
    try:
        row = column_distances(labelled, ["station"], ["value"]).first()
    finally:
        spark.conf.unset("spark.lagline.maxSeriesRows")
    ks, wasserstein = numpy_distances(a, b)
    assert row["ks_distance"] == pytest.approx(ks)
    assert row["wasserstein"] == pytest.approx(wasserstein)
    assert row["reference_std"] == pytest.approx(a.std())
    assert (row["n_reference"], row["n_current"]) == (150, 90)


def test_the_test_does_not_depend_on_the_size(spark):
    for count in (40, 1_500):
        rows = [("reference", float(i % 7)) for i in range(count)] + [("current", 3.0)] * 10
        labelled = spark.createDataFrame(rows, "slice string, value double")
        std = np.std([i % 7 for i in range(count)])
        for method in ("ks", "wasserstein"):
            row = column_drift(labelled, columns=["value"], method=method).first()
            assert row["method"] == method and row["ks_p_value"] is not None
            assert row["wasserstein_normed"] == pytest.approx(row["wasserstein"] / std)
    with pytest.raises(ValueError):
        column_drift(labelled, method="other")


def test_series_without_overlap_are_reported(spark):
    truth = [("a", i, float(i)) for i in range(20)] + [("b", i, 1.0) for i in range(5)]
    made = [("a", i, float(i)) for i in range(20)] + [("c", i, 1.0) for i in range(5)]

    def table(rows, name):
        df = spark.createDataFrame(rows, f"station string, day int, {name} double")
        return df.selectExpr("station", "timestamp_ntz'2024-01-01' + make_dt_interval(day) AS datetime", name)

    report = monitor(table(truth, "value"), table(made, "forecast"))
    found = {r.station: (r.n_points, r.drift_score, r.alert) for r in report.summary.collect()}
    assert set(found) == {"a", "c"} and found["c"] == (0, 0.0, False) and found["a"][0] == 20


def test_repeated_times_need_a_key(spark):
    truth = spark.sql("SELECT timestamp_ntz'2024-01-01' AS datetime, 1.0D AS value, id FROM range(2)")
    made = truth.withColumnRenamed("value", "forecast")
    with pytest.raises(ValueError):
        align(truth, made)
    assert align(truth, made, repeats=True).count() == 4
    assert align(truth, made, ["id"]).count() == 2


def test_positions_of_long_series(spark, tiny_tasks):
    rows = [("long" if i % 3 else "short", i % 50, i) for i in range(45)]
    df = spark.createDataFrame(rows, "s string, t int, i int")
    found = with_position(df, ["s"], ["t", "i"]).collect()
    for name in ("long", "short"):
        mine = sorted((r["position"], r["t"]) for r in found if r["s"] == name)
        assert [p for p, _ in mine] == list(range(1, len(mine) + 1))
        assert [t for _, t in mine] == sorted(t for _, t in mine)
        assert {r["series_rows"] for r in found if r["s"] == name} == {len(mine)}


def test_running_totals_and_quantiles_of_long_groups(spark, tiny_tasks):
    rng = np.random.default_rng(5)
    values = rng.normal(0, 1, 300).round(2)
    rows = [(None if i < 100 else "g", float(v), 1) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    totals = running_totals(df, ["g"], ["v"], {"upto": "n"}).groupBy("g").agg({"upto": "max"})
    assert {r[0]: r[1] for r in totals.collect()} == {None: 100, "g": 200}
    quantiles = exact_quantiles(df, ["g"], "v", [0.05, 0.5, 1])
    found = {r["g"]: r["quantiles"] for r in quantiles.collect()}
    np.testing.assert_allclose(found[None], np.quantile(values[:100], [0.05, 0.5, 1]))
    np.testing.assert_allclose(found["g"], np.quantile(values[100:], [0.05, 0.5, 1]))


@pytest.mark.parametrize("key", [(), ("k",)])
def test_recent_split_is_that_of_sorted_rows(spark, key):
    """Many series: short, long, with ties at the cut, with null times, and a null key."""
    draw = random.Random(3)
    rows = []
    for k, size in enumerate([0, 1, 2, 3, 59, 60, 61, 62, 400, 5000]):
        rows += [(k or None, draw.randrange(3 if size < 500 else 10**6), 1.0) for _ in range(size)]
    rows += [(11, None, 1.0)] * 40 + [(11, 5, 2.0)] * 25 + [(12, 7, 3.0)] * 100
    frame = spark.createDataFrame(rows, "k int, t int, v double").repartition(5)
    expected = []
    groups = {}
    for row in rows:
        groups.setdefault(row[0] if key else 0, []).append(row)
    for own in groups.values():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        earlier = len(own) // 2 if len(own) <= 60 else len(own) - 30
        labels = ["reference"] * earlier + ["current"] * (len(own) - earlier)
        expected += [(*r, label) for r, label in zip(own, labels, strict=True)]
    found = recent_split(frame, ["t", "v"], key)
    assert found.columns == ["k", "t", "v", "slice"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_sketch_ranks(spark):
    rows = spark.range(50_000).selectExpr("id % 2 AS g", "cast(hash(id) AS double) AS x")
    exact = quantiles(rows, ["g"], "x", [0.1, 0.5]).orderBy("g").collect()
    sketch = quantiles(rows, ["g"], "x", [0.1, 0.5], method="sketch").orderBy("g").collect()
    for a, b in zip(exact, sketch, strict=True):
        own = sorted(r.x for r in rows.where(F.col("g") == a.g).collect())
        for x, y in zip(a.quantiles, b.quantiles, strict=True):
            assert abs(bisect(own, x) - bisect(own, y)) <= 0.001 * len(own) + 1
    with pytest.raises(ValueError, match="exact or sketch"):
        quantiles(rows, ["g"], "x", [0.5], method="rough")
