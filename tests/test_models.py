import json
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lagline.functions.clean import quoted
from lagline.operators.filters import by_history_length, history_tail, matching_text
from lagline.plans.daily import daily_run
from lagline.plans.features import daily_features
from lagline.plans.forecasting import (
    choose_history,
    forecast,
    forecast_forest,
    forecast_seasonal,
    forecast_sequence,
    future_times,
    history_needed,
)
from lagline.plans.models import (
    Scaling,
    SequenceModel,
    load_meta,
    load_model,
    save_model,
    scaler_values,
)
from lagline.plans.scoring import score_files, score_rows
from lagline.plans.training import train, train_forest, train_seasonal, train_sequence
from lagline.sources.sinks import read_runs

START = datetime(2024, 1, 1)
KEY = ["station"]


def noisy(seed, n, level=50.0):
    rng = np.random.default_rng(seed)
    out = [level, level + 1]
    for _ in range(n - 2):
        out.append(level * 0.2 + 0.5 * out[-1] + 0.3 * out[-2] + rng.normal(0, 2))
    return out


def days(spark, values, step=timedelta(days=1)):
    rows = [(s, START + i * step, float(v)) for s, vs in values.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "station string, datetime timestamp_ntz, value double")


@pytest.fixture(scope="module")
def table(spark):
    return days(spark, {"a": noisy(1, 90), "b": noisy(2, 90, 80.0)}).cache()


@pytest.fixture(scope="module")
def forest(table):
    return train_forest(daily_features(table, key=KEY), KEY, trees=5, depth=4)


def test_forest_metrics(forest):
    row = forest.metrics.first()
    assert 0 < row["mae_tr"] <= row["rmse_tr"] and 0 < row["mae_va"] <= row["rmse_va"]
    sizes = {r["slice"]: r["count"] for r in forest.scored.groupBy("slice").count().collect()}
    n = sum(sizes.values())
    assert n == 2 * 75 and sizes["train"] == int(n * 0.8)
    latest = forest.scored.where("slice = 'train'").agg(F.max("datetime")).first()[0]
    first = forest.scored.where("slice = 'validation'").agg(F.min("datetime")).first()[0]
    assert latest <= first


def one_step(model, spark, features):
    row = spark.createDataFrame([tuple(features.values())], [*features])
    names = [*map(quoted, model.features)]
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(row)
    fitted = model.model.copy()
    fitted.setFeaturesCol("features").setPredictionCol("y")
    return fitted.transform(assembled).first()["y"]


@pytest.mark.parametrize("alignment", ["reference", "consistent"])
def test_forest_forecast_step_by_step(spark, table, forest, alignment):
    history = choose_history(table, forest.model, KEY)
    made = forecast_forest(forest.model, history, KEY, 3, "D", alignment)
    assert made.short.count() == 0
    rows = {"a": [], "b": []}
    for row in made.rows.orderBy("datetime").collect():
        rows[row["station"]].append(row["forecast"])
    values = [r["value"] for r in history.where("station = 'a'").orderBy("datetime").collect()]
    last = START + timedelta(days=89)
    for expected_at in range(3):
        at = last + timedelta(days=expected_at + (1 if alignment == "reference" else 0))
        shift = 0 if alignment == "reference" else 1
        inputs = {f"lag_{n}": values[-n - shift] for n in (1, 2, 3, 7, 14)}
        inputs |= {"roll_7": float(np.mean(values[-8:-1])), "dow": float(at.weekday())}
        inputs["month"] = float(at.month)
        y = one_step(forest.model, spark, inputs)
        assert rows["a"][expected_at] == pytest.approx(y)
        values.append(y)
    assert len(rows["b"]) == 3
    times = [r[0] for r in made.rows.select("datetime").distinct().orderBy("datetime").collect()]
    assert times == [last + timedelta(days=i) for i in (1, 2, 3)]


def test_features_that_cannot_be_derived_are_zero(spark, table):
    """A weather feature takes part in training and is 0 in a forecast."""
    built = daily_features(table.withColumn("wind.speed", F.col("value") % 7), key=KEY)
    assert "wind.speed" in built.features
    model = train_forest(built, KEY, trees=3, depth=4).model
    values = [r["value"] for r in table.where("station = 'a'").orderBy("datetime").collect()]
    made = forecast_forest(model, table, KEY, 1).rows.where("station = 'a'").first()
    at = START + timedelta(days=90)
    inputs = {f"lag_{n}": values[-n] for n in (1, 2, 3, 7, 14)}
    inputs |= {"roll_7": float(np.mean(values[-8:-1])), "dow": float(at.weekday())}
    inputs |= {"month": float(at.month), "wind.speed": 0.0}
    assert made["forecast"] == pytest.approx(one_step(model, spark, inputs))


def test_partial_rolling_window_at_forecast(spark):
    """With 14 values kept, a 24-row mean takes the 13 before the newest."""
    values = noisy(3, 60)
    table = daily_features(days(spark, {"a": values}), key=KEY)
    table = table._replace(
        frame=table.frame.withColumnRenamed("roll_7", "roll_24"),
        features=[f.replace("roll_7", "roll_24") for f in table.features],
    )
    model = train_forest(table, KEY, trees=3, depth=4).model
    made = forecast_forest(model, days(spark, {"a": values}), KEY, 1)
    at = START + timedelta(days=60)
    inputs = {f"lag_{n}": values[-n] for n in (1, 2, 3, 7, 14)}
    inputs |= {"roll_24": float(np.mean(values[-14:-1])), "dow": float(at.weekday())}
    inputs["month"] = float(at.month)
    assert made.rows.first()["forecast"] == pytest.approx(one_step(model, spark, inputs))


def test_short_series_do_not_stop_the_others(spark, forest):
    uneven = days(spark, {"a": noisy(1, 20), "c": [1.0, 2.0]})
    made = forecast_forest(forest.model, uneven, KEY, 2)
    assert {r["station"] for r in made.rows.collect()} == {"a"}
    assert [tuple(r) for r in made.short.collect()] == [("c", 2)]


def test_sequence_training_equals_least_squares(spark):
    values = np.array(noisy(4, 120))
    trained = train_sequence(days(spark, {"a": values}), KEY, seq_len=3)
    k = 3 + int((120 - 3) * 0.8)
    mean, std = values[:k].mean(), values[:k].std() + 1e-8
    z = (values - mean) / std
    x = np.column_stack([z[i : len(z) - 3 + i] for i in range(3)] + [np.ones(117)])
    y = z[3:]
    w, *_ = np.linalg.lstsq(x[: k - 3], y[: k - 3], rcond=None)
    np.testing.assert_allclose(trained.model.weights, w[:3], rtol=1e-6)
    errors = np.abs((x @ w) * std + mean - values[3:])
    row = trained.metrics.first()
    assert row["mae_tr"] == pytest.approx(errors[: k - 3].mean())
    assert row["mae_va"] == pytest.approx(errors[k - 3 :].mean())
    assert row["rmse_va"] == pytest.approx(np.sqrt((errors[k - 3 :] ** 2).mean()))


def test_sequence_scaler_on_all_rows(spark):
    values = np.array(noisy(4, 60))
    model = train_sequence(days(spark, {"a": values}), KEY, seq_len=3, scale_on="all").model
    assert (model.scaling.mean, model.scaling.std) == (
        pytest.approx(values.mean()),
        pytest.approx(values.std() + 1e-8),
    )


def test_sequence_forecast_by_hand(spark):
    model = SequenceModel(2, [0.25, 0.5], 0.1, Scaling([], 10.0, 2.0))
    made = forecast_sequence(model, days(spark, {"a": [9.0, 12.0, 14.0]}), KEY, 2, "H")
    z = [(v - 10) / (2 + 1e-8) for v in (12, 14)]
    first = 0.25 * z[0] + 0.5 * z[1] + 0.1
    second = 0.25 * z[1] + 0.5 * first + 0.1
    rows = made.rows.orderBy("datetime").collect()
    assert [r["forecast"] for r in rows] == pytest.approx([first * 2 + 10, second * 2 + 10])
    assert rows[0]["datetime"] == START + timedelta(days=2, hours=1)


def test_unknown_series_use_the_overall_scaler(spark, table):
    model = train_sequence(table, KEY, seq_len=3).model
    made = forecast_sequence(model, days(spark, {"new": noisy(9, 10)}), KEY, 1)
    assert made.rows.first()["forecast"] is not None


def test_seasonal_finds_a_weekly_pattern(spark):
    pattern = [0, 5, 9, 4, -3, -8, -7]
    values = [100 + 0.5 * i + pattern[i % 7] for i in range(84)]
    trained = train_seasonal(days(spark, {"a": values}), KEY, ridge=1e-4)
    assert trained.model.design.dropped == ["daily", "yearly"]
    assert trained.metrics.first()["mae_tr"] < 0.5
    made = forecast_seasonal(trained.model, days(spark, {"a": values}), KEY, 7)
    found = [r["forecast"] for r in made.rows.orderBy("datetime").collect()]
    wanted = [100 + 0.5 * i + pattern[i % 7] for i in range(84, 91)]
    assert np.abs(np.array(found) - wanted).max() < 6


def test_seasonal_equals_least_squares(spark):
    values = np.array(noisy(6, 70))
    trained = train_seasonal(days(spark, {"a": values}), KEY, ridge=0.0)
    design, k = trained.model.design, 56
    seconds = np.arange(70) * 86_400.0
    share = seconds / design.span
    terms = [share] + [np.maximum(share - c, 0) for c in design.changepoints]
    for period, n in design.harmonics:
        angle = 2 * np.pi * n * (START - datetime(1970, 1, 1)).total_seconds() / period
        angle = angle + 2 * np.pi * n * seconds / period
        terms += [np.sin(angle), np.cos(angle)]
    x = np.column_stack([*terms, np.ones(70)])
    w, *_ = np.linalg.lstsq(x[:k], values[:k], rcond=None)
    scored = trained.scored.orderBy("datetime").collect()
    np.testing.assert_allclose([r["forecast"] for r in scored][:k], (x @ w)[:k], atol=1e-4)
    assert [p / 86_400 for p, _ in design.harmonics] == [7.0] * 3


@pytest.mark.parametrize(
    "kind, settings", [("rf", {"trees": 3, "depth": 3}), ("prophet", {}), ("lstm", {"seq_len": 5})]
)
def test_one_series_needs_no_key(spark, table, kind, settings):
    one = table.where("station = 'a'")
    keyed, pooled = (train(one, kind, key, **settings) for key in (KEY, ()))
    assert list(pooled.metrics.first()) == pytest.approx(list(keyed.metrics.first()))
    made = forecast(pooled.model, one, (), 2).rows
    assert made.columns == ["datetime", "forecast"] and made.count() == 2


def test_seasonal_keeps_daily_terms_for_hours(spark):
    hours = days(spark, {"a": noisy(5, 24 * 20)}, timedelta(hours=1))
    design = train_seasonal(hours, KEY).model.design
    assert [n for p, n in design.harmonics if p == 86_400.0] == [1, 2, 3, 4]
    assert design.dropped == ["yearly"]


@pytest.mark.parametrize("kind", ["prophet", "lstm"])
def test_saved_models_forecast_the_same(spark, table, tmp_path, kind):
    settings = {"seq_len": 5} if kind == "lstm" else {}
    model = train(table, kind, KEY, **settings).model
    save_model(spark, model, f"{tmp_path}/m")
    again = load_model(spark, f"{tmp_path}/m")
    made = [forecast(m, table, KEY, 3).rows for m in (model, again)]
    rows = [m.orderBy(*KEY, "datetime").collect() for m in made]
    assert rows[0] == rows[1] and len(rows[0]) == 6


def test_saved_forest(spark, table, forest, tmp_path):
    save_model(spark, forest.model, f"{tmp_path}/m")
    assert load_meta(spark, f"{tmp_path}/m")["kind"] == "rf"
    again = load_model(spark, f"{tmp_path}/m")
    assert again.features == forest.model.features
    assert again.model.getNumTrees == 5


def test_missing_model_parts(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_model(spark, f"{tmp_path}/none")
    meta = {"kind": "lstm", "weights": [1.0], "intercept": 0.0, "key": [], "mean": 1, "std": 2}
    (tmp_path / "meta").mkdir()
    (tmp_path / "meta" / "part.txt").write_text(json.dumps(meta))
    with pytest.raises(KeyError):
        load_model(spark, str(tmp_path))
    assert scaler_values(meta) == (1.0, 2.0)
    assert scaler_values({"scaler": {"mean": 3, "std": 4}}) == (3.0, 4.0)
    with pytest.raises(KeyError):
        scaler_values({})


class Always42:
    def transform(self, rows):
        return rows.withColumn("prediction", F.lit(42.0))


def test_score_rows(spark):
    schema = "datetime string, station_id bigint, pollutant string, value bigint"
    row = ("2024-01-01T00:00:00", 1, "NO2", 20)
    scored = score_rows(spark.createDataFrame([row], schema), Always42())
    assert [r["prediction"] for r in scored.collect()] == [42.0]
    assert score_rows(spark.createDataFrame([], schema), Always42()).count() == 0


def test_score_rows_with_a_forest(table, forest):
    rows = daily_features(table, key=KEY)
    scored = score_rows(rows.frame, forest.model.model, forest.model.features)
    assert scored.count() == rows.frame.count()


def test_score_files(spark, table, forest, tmp_path):
    rows = daily_features(table, key=KEY).frame
    rows.drop("target").write.json(f"{tmp_path}/rows")
    save_model(spark, forest.model, f"{tmp_path}/m")
    scored = score_files(spark, f"{tmp_path}/rows", rows.schema, f"{tmp_path}/m", f"{tmp_path}/out")
    assert scored.count() == rows.count()
    assert scored.where("forecast IS NULL").count() == 0


def test_long_tails(spark, tiny_tasks):
    table = days(spark, {"a": range(1500), "b": range(5)})
    sizes = history_tail(table, KEY, 1200).groupBy("station").count()
    assert sizes.orderBy("station").collect() == [("a", 1200), ("b", 5)]
    assert history_tail(table, [], 3).agg(F.min("value")).first()[0] == 1497.0


def test_history_filters(spark):
    uneven = days(spark, {"a": range(10), "Ab": range(3), "c": range(5)})
    assert {r[0] for r in history_tail(uneven, KEY, 2).select("value").collect()} == {
        8.0, 9.0, 1.0, 2.0, 3.0, 4.0
    }
    enough, short = by_history_length(uneven, KEY, 5)
    assert enough.count() == 15 and [tuple(r) for r in short.collect()] == [("Ab", 3)]
    assert by_history_length(uneven, [], 19)[0].count() == 0
    assert matching_text(uneven, "station", "^A").count() == 13


def test_choose_history(spark, forest):
    hours = days(spark, {"a": range(50)}, timedelta(hours=1)).withColumnsRenamed(
        {"station": "station_name"}
    ).withColumn("pollutant", F.lit("pm2,5 "))
    key = ["station_name"]
    chosen = choose_history(hours, forest.model, key, "H", 5, station="A", pollutant="PM2.5")
    assert chosen.count() == 14  # the largest lag
    assert choose_history(hours, forest.model, key, "H", 20, pollutant="NO2").count() == 0
    with pytest.raises(ValueError):
        choose_history(hours.drop("pollutant"), forest.model, key, "H", pollutant="NO2")


def test_future_times(spark):
    times = future_times(days(spark, {"a": [1.0]}), KEY, 2, "H").collect()
    assert [r["datetime"] for r in times] == [START + timedelta(hours=i) for i in (1, 2)]


@pytest.mark.parametrize(
    "model, settings", [("rf", {"trees": 3, "depth": 3}), ("lstm", {"seq_len": 7})]
)
def test_daily_run(spark, table, tmp_path, model, settings):
    table.where("datetime < '2024-02-15'").write.parquet(f"{tmp_path}/a")
    table.where("datetime >= '2024-02-15'").write.parquet(f"{tmp_path}/b")
    paths = [f"{tmp_path}/a", f"{tmp_path}/b"]
    run = daily_run(spark, paths, f"{tmp_path}/out", model, horizon=4, key=KEY, **settings)
    assert run.forecast.count() == 8
    points = [r.n_points for r in run.report.summary.collect()]
    assert points == [0, 0]  # nothing observed yet for the days ahead
    kinds = [r["kind"] for r in read_runs(spark, f"{tmp_path}/out/runs").collect()]
    assert sorted(kinds) == ["forecast", "train"]
    written = spark.read.json(f"{tmp_path}/out/predictions/forecast_json")
    assert written.count() == 8


def test_text_filters_know_accented_letters(spark):
    rows = [("Étienne",), ("ÉTIENNE",), ("étienne",), ("etienne",), (None,)]
    df = spark.createDataFrame(rows, "station string")
    assert matching_text(df, "station", "étienne").count() == 3


def test_history_is_long_enough_for_the_model(spark, table, forest):
    need = history_needed(forest.model.features, "consistent")
    chosen = choose_history(table, forest.model, KEY, history_window=2, alignment="consistent")
    assert {r["count"] for r in chosen.groupBy(*KEY).count().collect()} == {need}
    made = forecast_forest(forest.model, chosen, KEY, 3, alignment="consistent")
    assert made.short.isEmpty() and made.rows.count() == 6


def test_keys_are_found(spark, table):
    given = train(table, "lstm", KEY, seq_len=5)
    found = train(table, "lstm", seq_len=5)
    pooled = train(table, "lstm", (), seq_len=5)
    assert found.metrics.collect() == given.metrics.collect() != pooled.metrics.collect()
