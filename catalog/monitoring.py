"""Splits, metrics, drift and alerts."""

from pyspark.sql import functions as F

from catalog.registry import (
    DAILY,
    LABELLED,
    READINGS,
    daily,
    naive,
    naive_forecast,
    query,
    readings,
    rounded,
    table,
)
from lagline.operators.drift import (
    column_drift,
    dataset_drift as drift_flag,
    error_histogram as histogram,
    largest_errors,
    median_drift as median_shift,
)
from lagline.operators.joins import align
from lagline.operators.metrics import (
    forecast_summary as summarise,
    regression_metrics as errors,
    regression_quality as quality,
    slice_metrics as metrics_of_slices,
)
from lagline.operators.splits import holdout, recent_split
from lagline.plans.monitoring import monitor

KEY = ["pollutant"]
ORDER = ["datetime", "value", "forecast"]

DAILY_PAIRS = f"{DAILY}, {naive('daily')}"
READING_PAIRS = f"{READINGS}, {naive('readings')}"

DECISIONS = """cells AS (
    SELECT pollutant, slice, 'value' AS "column", value AS x FROM labelled UNION ALL
    SELECT pollutant, slice, 'forecast', forecast FROM labelled),
  spread AS (SELECT pollutant, "column", stddev_pop(x) AS std FROM cells
             WHERE slice = 'reference' GROUP BY 1, 2),
  counted AS (SELECT pollutant, "column", x, count(*) FILTER (slice = 'reference') AS r,
                     count(*) FILTER (slice = 'current') AS c
              FROM cells GROUP BY 1, 2, 3),
  running AS (
    SELECT pollutant, "column", sum(r) OVER w AS fr, sum(c) OVER w AS fc,
           sum(r) OVER p AS nr, sum(c) OVER p AS nc, lead(x) OVER w - x AS gap
    FROM counted WINDOW w AS (PARTITION BY pollutant, "column" ORDER BY x),
                        p AS (PARTITION BY pollutant, "column")),
  distances AS (
    SELECT pollutant, "column", CAST(nr AS BIGINT) AS n_reference, CAST(nc AS BIGINT) AS n_current,
           max(abs(fr / nr - fc / nc)) AS d,
           sum(abs(fr / nr - fc / nc) * coalesce(gap, 0)) AS wasserstein
    FROM running GROUP BY 1, 2, 3, 4),
  tested AS (
    SELECT *, d * sqrt(n_reference * n_current / (n_reference + n_current)) AS scaled
    FROM distances JOIN spread USING (pollutant, "column")),
  drift AS (
    SELECT pollutant, "column", n_reference, n_current, d AS ks_distance,
           CASE WHEN scaled < 0.2 THEN 1.0 ELSE greatest(least(list_sum(list_transform(
             range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END
               * exp(-2.0 * k * k * scaled * scaled))), 1.0), 0.0) END AS ks_p_value,
           wasserstein, wasserstein / std AS wasserstein_normed,
           'METHOD' AS method
    FROM tested),
  decided AS (
    SELECT *, CASE WHEN method = 'ks' THEN ks_p_value < 0.05
              ELSE wasserstein_normed >= 0.1 END AS drifted FROM drift)"""

DISTANCES = DECISIONS.replace("METHOD", "ks")
MOVED = DECISIONS.replace("METHOD", "wasserstein")

ROUNDED_DRIFT = """SELECT pollutant, "column", n_reference, n_current,
         round(ks_distance, 6) AS ks_distance, round(ks_p_value, 6) AS ks_p_value,
         round(wasserstein, 6) AS wasserstein,
         round(wasserstein_normed, 6) AS wasserstein_normed, method, drifted FROM decided"""


def _pairs(spark, folder):
    return naive_forecast(readings(spark, folder))


def _labelled(spark, folder):
    return recent_split(_pairs(spark, folder), ORDER, KEY)


@query(f"""WITH {DAILY_PAIRS}
  SELECT pollutant, datetime, round(value, 9) AS value, round(forecast, 9) AS forecast
  FROM pairs""")
def align_truth(spark, folder):
    truth = daily(spark, folder)
    pairs = align(truth, naive_forecast(truth).drop("value"), KEY)
    return rounded(pairs, ["value", "forecast"], 9)


@query(f"""WITH {READING_PAIRS}
  SELECT round(avg(abs(value - forecast)), 6) AS mae,
         round(sqrt(avg((value - forecast) ** 2)), 6) AS rmse FROM pairs""")
def regression_metrics(spark, folder):
    return rounded(errors(_pairs(spark, folder)), ["mae", "rmse"])


@query(f"""WITH {READING_PAIRS}
  SELECT station_id, pollutant, round(avg(abs(value - forecast)), 6) AS mae,
         round(sqrt(avg((value - forecast) ** 2)), 6) AS rmse FROM pairs GROUP BY 1, 2""")
def metrics_by_series(spark, folder):
    return rounded(errors(_pairs(spark, folder), ["station_id", *KEY]), ["mae", "rmse"])


@query(f"""WITH {READING_PAIRS}
  SELECT pollutant, round(avg(forecast), 6) AS forecast_mean,
         round(stddev_pop(forecast), 6) AS forecast_std,
         min(forecast) AS forecast_min, max(forecast) AS forecast_max
  FROM pairs GROUP BY 1""")
def forecast_summary(spark, folder):
    found = summarise(_pairs(spark, folder), KEY)
    return rounded(found, ["forecast_mean", "forecast_std"])


@query("""WITH ranked AS (
    SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS pos, count(*) OVER () AS n
    FROM orders)
  SELECT o_orderkey, o_orderdate,
         CASE WHEN pos <= floor(n * 0.8) THEN 'train' ELSE 'validation' END AS slice
  FROM ranked""")
def holdout_split(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return holdout(orders, ["o_orderdate", "o_orderkey"])


@query(f"""WITH {READINGS}, ranked AS (
    SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY datetime) AS pos,
           count(*) OVER (PARTITION BY station_id) AS n
    FROM readings)
  SELECT station_id, pollutant, datetime, value,
         CASE WHEN pos <= floor(n * 0.8) THEN 'train' ELSE 'validation' END AS slice
  FROM ranked""")
def holdout_by_series(spark, folder):
    return holdout(readings(spark, folder), ["datetime"], ["station_id"])


@query(f"""WITH {READING_PAIRS}, ranked AS (
    SELECT *, abs(value - forecast) AS e,
           row_number() OVER (ORDER BY datetime) <= floor(count(*) OVER () * 0.8) AS train
    FROM pairs)
  SELECT round(avg(e) FILTER (train), 6) AS mae_tr,
         round(sqrt(avg(e * e) FILTER (train)), 6) AS rmse_tr,
         round(avg(e) FILTER (NOT train), 6) AS mae_va,
         round(sqrt(avg(e * e) FILTER (NOT train)), 6) AS rmse_va
  FROM ranked""")
def slice_metrics(spark, folder):
    split = holdout(_pairs(spark, folder), ["datetime"])
    found = metrics_of_slices(split, "value")
    return rounded(found, found.columns)


@query(f"WITH {READING_PAIRS}, {LABELLED} SELECT pollutant, datetime, slice FROM labelled")
def recent_window(spark, folder):
    return _labelled(spark, folder).select("pollutant", "datetime", "slice")


@query(f"""WITH {READING_PAIRS}, {LABELLED}
  SELECT pollutant, round(abs(quantile_cont(value, 0.5) FILTER (slice = 'current')
         - quantile_cont(value, 0.5) FILTER (slice = 'reference')), 6) AS drift_score
  FROM labelled GROUP BY 1""")
def median_drift(spark, folder):
    return rounded(median_shift(_labelled(spark, folder), KEY), ["drift_score"])


@query(f"""WITH {READING_PAIRS}, ranked AS (
    SELECT value, row_number() OVER (ORDER BY datetime DESC) <= 30 AS recent FROM pairs)
  SELECT round(abs(quantile_cont(value, 0.5) FILTER (recent)
         - quantile_cont(value, 0.5) FILTER (NOT recent)), 6) AS drift_score
  FROM ranked""")
def median_drift_pooled(spark, folder):
    split = recent_split(_pairs(spark, folder), ORDER)
    return rounded(median_shift(split), ["drift_score"])


@query(f"""WITH {READING_PAIRS}, {LABELLED}, e AS (
    SELECT pollutant, slice, value, forecast - value AS e, abs(forecast - value) AS a
    FROM labelled)
  SELECT pollutant, slice, count(*) AS n_points, round(avg(e), 6) AS mean_error,
         round(stddev_samp(e), 6) AS error_std, round(avg(a), 6) AS mae,
         round(stddev_samp(a), 6) AS abs_error_std,
         round(avg(a / nullif(abs(value), 0) * 100), 4) AS mape,
         round(stddev_samp(a / nullif(abs(value), 0) * 100), 4) AS abs_perc_error_std,
         round(max(a), 6) AS max_abs_error, round(sqrt(avg(e * e)), 6) AS rmse,
         round(1 - sum(e * e) / (var_pop(value) * count(*)), 6) AS r2
  FROM e GROUP BY 1, 2""")
def regression_quality(spark, folder):
    found = quality(_labelled(spark, folder), [*KEY, "slice"])
    percents = ["mape", "abs_perc_error_std"]
    others = [c for c in found.columns[3:] if c not in percents]
    return rounded(rounded(found, others), percents, 4)


@query(f"""WITH {READING_PAIRS}, {LABELLED}, e AS (
    SELECT pollutant, slice, forecast - value AS e FROM labelled),
  spans AS (SELECT pollutant, min(e) AS low, max(e) AS high FROM e GROUP BY 1),
  placed AS (
    SELECT pollutant, slice, low, (high - low) / 10 AS width,
           CAST(least(floor((e - low) / ((high - low) / 10)), 9) AS BIGINT) AS bin
    FROM e JOIN spans USING (pollutant))
  SELECT pollutant, slice, bin, round(low + width * bin, 6) AS bin_low,
         round(low + width * (bin + 1), 6) AS bin_high, count(*) AS n_points
  FROM placed GROUP BY 1, 2, 3, 4, 5""")
def error_histogram(spark, folder):
    return rounded(histogram(_labelled(spark, folder), KEY), ["bin_low", "bin_high"])


@query(f"""WITH {READING_PAIRS}, {LABELLED}, e AS (
    SELECT *, forecast - value AS e FROM labelled),
  cuts AS (SELECT pollutant, slice, quantile_cont(e, 0.05) AS low, quantile_cont(e, 0.95) AS high
           FROM e GROUP BY 1, 2)
  SELECT pollutant, slice, CASE WHEN e <= low THEN 'underestimated'
           WHEN e >= high THEN 'overestimated' ELSE 'majority' END AS part,
         count(*) AS n_points, round(avg(e), 6) AS mean_error, round(avg(value), 6) AS mean_value,
         round(avg(forecast), 6) AS mean_forecast
  FROM e JOIN cuts USING (pollutant, slice) GROUP BY 1, 2, 3""")
def top_errors(spark, folder):
    found = largest_errors(_labelled(spark, folder), KEY)
    return rounded(found, ["mean_error", "mean_value", "mean_forecast"])


def _rounded_drift(labelled, method):
    names = ["ks_distance", "ks_p_value", "wasserstein", "wasserstein_normed"]
    return rounded(column_drift(labelled, KEY, method=method), names)


def _labelled_days(spark, folder):
    return recent_split(naive_forecast(daily(spark, folder)), ORDER, KEY)


@query(f"WITH {DAILY_PAIRS}, {LABELLED}, {DISTANCES} {ROUNDED_DRIFT}")
def ks_drift(spark, folder):
    return _rounded_drift(_labelled_days(spark, folder), "ks")


@query(f"WITH {READING_PAIRS}, {LABELLED}, {DISTANCES} {ROUNDED_DRIFT}")
def ks_drift_readings(spark, folder):
    return _rounded_drift(_labelled(spark, folder), "ks")


@query(f"WITH {READING_PAIRS}, {LABELLED}, {MOVED} {ROUNDED_DRIFT}")
def wasserstein_drift(spark, folder):
    return _rounded_drift(_labelled(spark, folder), "wasserstein")


@query(f"WITH {DAILY_PAIRS}, {LABELLED}, {MOVED} {ROUNDED_DRIFT}")
def wasserstein_drift_days(spark, folder):
    return _rounded_drift(_labelled_days(spark, folder), "wasserstein")


@query(f"""WITH {READING_PAIRS}, {LABELLED}, {DISTANCES}
  SELECT pollutant, avg(CAST(drifted AS DOUBLE)) AS drifted_share,
         avg(CAST(drifted AS DOUBLE)) >= 0.5 AS dataset_drift
  FROM decided GROUP BY 1""")
def dataset_drift(spark, folder):
    return drift_flag(column_drift(_labelled(spark, folder), KEY), KEY)


ALERT = f"""WITH {DAILY_PAIRS}, {LABELLED}, {DISTANCES},
  flags AS (SELECT pollutant, avg(CAST(drifted AS DOUBLE)) >= 0.5 AS dataset_drift
            FROM decided GROUP BY 1),
  errors AS (
    SELECT pollutant, count(*) AS n_points, avg(abs(value - forecast)) AS mae,
           sqrt(avg((value - forecast) ** 2)) AS rmse,
           abs(quantile_cont(value, 0.5) FILTER (slice = 'current')
             - quantile_cont(value, 0.5) FILTER (slice = 'reference')) AS drift_score
    FROM labelled GROUP BY 1)
  SELECT pollutant, n_points, round(mae, 9) AS mae, round(rmse, 9) AS rmse,
         round(drift_score, 9) AS drift_score, dataset_drift,
         mae > 15 OR drift_score > 10 OR dataset_drift AS alert
  FROM errors JOIN flags USING (pollutant)"""


@query(ALERT)
def alert(spark, folder):
    truth = daily(spark, folder)
    report = monitor(truth, naive_forecast(truth).drop("value"), KEY)
    return rounded(report.summary, ["mae", "rmse", "drift_score"], 9)


@query(ALERT.replace("SELECT pollutant, n_points", "SELECT pollutant AS station, n_points"))
def alert_by_station(spark, folder):
    """The key left out: the station column that both tables have."""
    truth = daily(spark, folder)
    forecasts = naive_forecast(truth).drop("value")
    named = [t.withColumnRenamed("pollutant", "station") for t in (truth, forecasts)]
    return rounded(monitor(*named).summary, ["mae", "rmse", "drift_score"], 9)


@query(f"""WITH {DAILY}
  SELECT pollutant, CAST(0 AS BIGINT) AS n_points, CAST(NULL AS DOUBLE) AS mae,
         CAST(NULL AS DOUBLE) AS rmse, 0.0::DOUBLE AS drift_score, false AS dataset_drift,
         false AS alert
  FROM daily GROUP BY 1""")
def alert_without_overlap(spark, folder):
    """Forecasts of later times only: every series is reported, without points."""
    truth = daily(spark, folder)
    later = F.col("datetime") + F.expr("INTERVAL 1000 DAYS")
    forecasts = naive_forecast(truth).drop("value").withColumn("datetime", later)
    return monitor(truth, forecasts, KEY).summary
