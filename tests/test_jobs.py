"""Model versions, history state, fits per series, backtests and sparse bends."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagline.plans.models import Scaling, SequenceModel, load_model, save_model, write_parts
from lagline.plans.per_series import fit_per_series, rolling_backtest
from lagline.plans.state import history_state, load_state, merge_states, update_state
from lagline.plans.training import sparse_weights, train_seasonal
from lagline.session import scratch_path
from lagline.sources.versions import new_version, newest_version, prune_versions, versions


def test_readers_take_the_newest_complete_version(spark):
    path = scratch_path(spark, "model")
    assert newest_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        load_model(spark, path)
    table = spark.createDataFrame([("a", 1.0, 2.0)], "k string, mean double, std double")
    for weight in (0.1, 0.2, 0.3):
        save_model(spark, SequenceModel(1, [weight], 0.0, Scaling(["k"], 0.0, 1.0, table)), path)
    write_parts(SequenceModel(1, [0.9], 0.0, Scaling(["k"], 0.0, 1.0, table)), new_version(path))
    loaded = load_model(spark, path)
    assert loaded.weights == [0.3]
    save_model(spark, loaded, path)  # its own scaler is read while the next version is written
    assert [done for _, done in versions(spark, path)] == [True, True, True, False, True]
    assert len(prune_versions(spark, path, keep=1)) == 4
    assert load_model(spark, path).scaling.per_series.collect() == table.collect()
    with pytest.raises(ValueError, match="at least 1"):
        prune_versions(spark, path, keep=0)


def test_state_of_parts_is_that_of_all(spark):
    draw = random.Random(1)
    rows = [
        (draw.choice(["a", "b", None]), draw.randrange(1000), float(draw.randrange(5)))
        for _ in range(400)
    ] + [("short", 3, 1.0)]
    frame = spark.createDataFrame(rows, "k string, t int, value double").selectExpr(
        "k", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, t) AS datetime", "value"
    )
    part = F.pmod(F.hash("datetime", "value"), F.lit(4))
    parts = [frame.where(part == n) for n in range(4)]
    whole = sorted(history_state(frame, ["k"], 7).collect(), key=str)
    merged = merge_states([history_state(p, ["k"], 7) for p in reversed(parts)], ["k"], 7)
    assert sorted(merged.collect(), key=str) == whole
    path = scratch_path(spark, "state")
    assert load_state(spark, path) is None
    for p in parts:
        update_state(spark, path, p, ["k"], 7)
    assert sorted(load_state(spark, path).collect(), key=str) == whole
    assert {len(r.history) for r in whole} == {1, 7}
    pooled = history_state(frame, [], 7).first().history
    assert len(pooled) == 7


def test_weights_per_series(spark):
    draw = np.random.default_rng(2)
    rows, expected = [], {}
    for k in range(6):
        x = draw.normal(size=(40, 3)) * [1, 100, 0.01] + [5, -300, 0]
        if k == 1:
            x[:, 2] = 7.0  # a constant
        if k == 2:
            x[:, 2] = x[:, 0]  # two alike
        y = x @ [1.0, -0.02, 3.0] + k + draw.normal(size=40) * 0.1
        rows += [(k, *map(float, r), float(v)) for r, v in zip(x, y, strict=True)]
        design = np.c_[np.ones(40), x]
        expected[k] = design @ np.linalg.lstsq(design, y, rcond=None)[0], x
    rows += [(9, 1.0, 2.0, 3.0, 4.0), (0, None, 1.0, 1.0, 1.0), (0, 1.0, 1.0, 1.0, float("nan"))]
    frame = spark.createDataFrame(rows, "k int, a double, b double, c double, y double")
    found = {r.k: r for r in fit_per_series(frame, ["k"], ["a", "b", "c"], "y").collect()}
    for k, (fitted, x) in expected.items():
        assert found[k].n_rows == 40
        assert np.allclose(found[k].intercept + x @ found[k].weights, fitted, atol=1e-6)
    assert found[1].weights[2] == 0.0
    assert (found[9].intercept, found[9].weights) == (4.0, [0.0, 0.0, 0.0])
    assert fit_per_series(frame.limit(0), ["k"], ["a"], "y").collect() == []
    with pytest.raises(ValueError, match="at most"):
        fit_per_series(frame, ["k"], ["a"] * 40, "y")


def days(spark, values, key="x"):
    rows = [(key, i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, i int, value double").selectExpr(
        "k", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(i) AS datetime", "value"
    )


def test_backtest_repeats_a_fit_at_each_cut(spark):
    draw = np.random.default_rng(3)
    values = np.cumsum(draw.normal(size=80)) + 50
    table = days(spark, values).union(days(spark, values[:10], "short"))
    at = [r.datetime for r in days(spark, values).orderBy("datetime").collect()]
    cuts = [at[40], at[41], at[60], at[77]]
    found = {(r.k, r.cut): r for r in rolling_backtest(table, cuts, ["k"], 5, 4).collect()}
    for cut, place in zip(cuts, (40, 41, 60, 77), strict=True):
        x = np.stack([values[i : place + 1 - 5 + i] for i in range(5)], axis=1)
        y = values[5 : place + 1]
        w = np.linalg.lstsq(np.c_[np.ones(len(x)), x], y, rcond=None)[0]
        now, errors = list(values[: place + 1]), []
        for step in range(4):
            now.append(w[0] + np.dot(w[1:], now[-5:]))
            if place + 1 + step < len(values):
                errors.append(now[-1] - values[place + 1 + step])
        row = found["x", cut]
        assert (row.n_train, row.n_points) == (len(y), len(errors))
        assert row.mae == pytest.approx(np.abs(errors).mean(), abs=1e-7)
        assert row.rmse == pytest.approx(np.sqrt(np.square(errors).mean()), abs=1e-7)
        # A series that has ended is forecast from its own end, where no truth is.
        assert (found["short", cut].n_train, found["short", cut].n_points) == (5, 0)
    with pytest.raises(ValueError, match="no cuts"):
        rolling_backtest(table, [], ["k"])


def test_one_planted_bend_is_found(spark):
    draw = np.random.default_rng(4)
    i = np.arange(300)
    values = 10 + 0.05 * i + 0.4 * np.maximum(i - 115, 0) + draw.normal(size=300) * 0.3
    table = days(spark, values)
    settings = {"share": 0.0, "components": (), "changepoints": 24}
    sparse = train_seasonal(table, ["k"], sparse=0.001, **settings).model
    at, used = sparse.design.changepoints, sparse.weights[1:]
    strong = [c for c, w in zip(at, used, strict=True) if abs(w) > 0.2 * max(map(abs, used))]
    assert 0 < len(strong) <= 3 and all(abs(c - 115 / 299) < 0.05 for c in strong)
    assert sum(w == 0 for w in used) >= 18
    ridge = train_seasonal(table, ["k"], **settings).model
    assert sum(w == 0 for w in ridge.weights[1:]) < 3


def test_no_penalty_is_least_squares():
    draw = np.random.default_rng(5)
    x, y = draw.normal(size=(50, 4)), draw.normal(size=50)
    terms = np.c_[np.ones(50), x, y]
    weights, intercept = sparse_weights(terms.T @ terms, [1, 3], 0.0)
    expected = np.linalg.lstsq(np.c_[np.ones(50), x], y, rcond=None)[0]
    assert np.allclose([intercept, *weights], expected, atol=1e-6)
    weights, _ = sparse_weights(terms.T @ terms, [1, 3], 100.0)
    assert weights[1] == weights[3] == 0.0 != weights[0]


