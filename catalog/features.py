"""Feature tables, windows and cleaning."""

from pyspark.sql import functions as F

from catalog.registry import (
    DAILY,
    HOURLY,
    READINGS,
    as_bigint,
    daily,
    hourly,
    query,
    readings,
    rounded,
    table,
)
from lagline.functions.clean import (
    calendar,
    epoch_micros,
    from_zscore,
    instant_to_utc,
    normal_label,
    standard_rows,
    utc_to_instant,
    zscore,
)
from lagline.functions.history import mean_before_newest
from lagline.operators.joins import attach_weather, time_grid
from lagline.operators.metrics import scaler
from lagline.operators.series import (
    attach_by_key,
    exact_quantiles,
    match_keys,
    quantiles,
    with_position,
)
from lagline.operators.windows import median_gap, sequences, window_features
from lagline.plans.features import (
    DAILY_LAGS,
    HOURLY_LAGS,
    daily_features as build_daily,
    featurise_readings,
    hourly_features as build_hourly,
)
from lagline.plans.forecasting import future_times, history_arrays

CALENDAR = ["hour", "dow", "month"]
DAILY_NUMBERS = ["value", "roll_7", "target", *(f"lag_{n}" for n in DAILY_LAGS)]


def _lags(lags, over="w"):
    return ",\n         ".join(f"lag(value, {n}) OVER {over} AS lag_{n}" for n in lags)


def _roll(n, key="pollutant", places=6):
    frame = (
        f"(PARTITION BY {key} ORDER BY datetime ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    )
    return (
        f"CASE WHEN count(value) OVER {frame} = {n} "
        f"THEN round(avg(value) OVER {frame}, {places}) END AS roll_{n}"
    )


def _complete(columns):
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


def _hourly_sql(source, extra="", key="pollutant", drop=()):
    return f"""
  SELECT * FROM (
    SELECT *, {_lags(HOURLY_LAGS)},
         {_roll(24, key)},
         CAST(hour(datetime) AS BIGINT) AS hour,
         CAST(isodow(datetime) - 1 AS BIGINT) AS dow,
         CAST(month(datetime) AS BIGINT) AS month,
         lead(value) OVER w AS target
    FROM {source}
    WINDOW w AS (PARTITION BY {key} ORDER BY datetime))
  WHERE lag_24 IS NOT NULL AND target IS NOT NULL AND roll_24 IS NOT NULL {extra}"""


@query(f"""WITH {DAILY}
  SELECT pollutant, datetime, dow, month, {", ".join(
      f"round({c}, 9) AS {c}" for c in DAILY_NUMBERS)}
  FROM (
    SELECT pollutant, datetime, value, {_lags(DAILY_LAGS)},
         {_roll(7, places=9)},
         CAST(isodow(datetime) - 1 AS BIGINT) AS dow,
         CAST(month(datetime) AS BIGINT) AS month,
         lead(value) OVER w AS target
    FROM daily WINDOW w AS (PARTITION BY pollutant ORDER BY datetime))
  WHERE lag_14 IS NOT NULL AND roll_7 IS NOT NULL AND target IS NOT NULL""")
def daily_features(spark, folder):
    built = build_daily(daily(spark, folder), key=["pollutant"])
    return rounded(as_bigint(built.frame, CALENDAR[1:]), DAILY_NUMBERS, 9)


@query(f"WITH {READINGS} {_hourly_sql('readings')}")
def hourly_features(spark, folder):
    built = build_hourly(readings(spark, folder), key=["pollutant"])
    return rounded(as_bigint(built.frame, CALENDAR), ["roll_24"])


@query(f"WITH {READINGS} {_hourly_sql('readings', key='station_id')}")
def hourly_features_by_station(spark, folder):
    built = build_hourly(readings(spark, folder), key=["station_id"])
    return rounded(as_bigint(built.frame, CALENDAR), ["roll_24"])


@query(f"""WITH {HOURLY},
  weather AS (
    SELECT date_trunc('hour', ts) AS datetime, max(value) AS temp
    FROM events WHERE event_type = 'purchase' GROUP BY 1),
  joined AS (SELECT * FROM hourly LEFT JOIN weather USING (datetime))
  {_hourly_sql('joined', 'AND temp IS NOT NULL')}""")
def hourly_features_weather(spark, folder):
    hours = hourly(spark, folder)
    weather = hours.where("pollutant = 'purchase'").select(
        "datetime", F.col("value").alias("temp")
    )
    built = build_hourly(hours, weather, key=["pollutant"])
    return rounded(as_bigint(built.frame, CALENDAR), ["roll_24"])


@query(f"""WITH sites AS (
    SELECT ts AS datetime, concat('Site-', user_id // 50) AS station_name,
           event_type AS pollutant, value
    FROM events
    WHERE regexp_matches(concat('Site-', user_id // 50), 'SITE-[01]', 'i')
      AND event_type = 'click')
  {_hourly_sql('sites', key='station_name, pollutant')}""")
def featurise_job(spark, folder):
    site = F.concat(F.lit("Site-"), F.floor(F.col("station_id") / 50).cast("string"))
    columns = ["datetime", site.alias("station_name"), "pollutant", "value"]
    rows = readings(spark, folder).select(*columns)
    built = featurise_readings(rows, station="SITE-[01]", pollutant="click")
    return rounded(as_bigint(built.frame, CALENDAR), ["roll_24"])


@query("""WITH hours AS (
    SELECT date_trunc('hour', ts) AS datetime, event_type AS pollutant, value FROM events)
  SELECT datetime, pollutant, count(*) AS n_rows, round(sum(value), 6) AS total
  FROM hours JOIN (SELECT DISTINCT datetime FROM hours) USING (datetime)
  GROUP BY 1, 2""")
def time_grid_join(spark, folder):
    hour = F.date_trunc("hour", "datetime").cast("timestamp_ntz")
    hours = readings(spark, folder).drop("station_id").withColumn("datetime", hour)
    joined = attach_weather(hours, time_grid(hours))
    return joined.groupBy("datetime", "pollutant").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 6).alias("total")
    )


@query(f"""WITH {READINGS}
  SELECT *, {_lags(HOURLY_LAGS)} FROM readings
  WINDOW w AS (PARTITION BY pollutant ORDER BY datetime)""")
def lag_values(spark, folder):
    return window_features(
        readings(spark, folder), ["pollutant"], ["datetime"], lags=HOURLY_LAGS
    )


@query(f"WITH {READINGS} SELECT *, {_roll(7)}, {_roll(24)} FROM readings")
def rolling_means(spark, folder):
    rows = window_features(
        readings(spark, folder), ["pollutant"], ["datetime"], rolls=[7, 24]
    )
    return rounded(rows, ["roll_7", "roll_24"])


@query(f"""WITH {READINGS}
  SELECT *, lead(value) OVER (PARTITION BY station_id ORDER BY datetime) AS target
  FROM readings""")
def next_target(spark, folder):
    return window_features(
        readings(spark, folder), ["station_id"], ["datetime"], target="target"
    )


@query(f"""WITH {READINGS}, gaps AS (
    SELECT (epoch_us(datetime) - lag(epoch_us(datetime)) OVER (
             PARTITION BY pollutant ORDER BY datetime)) / 1000000 AS gap
    FROM readings)
  SELECT round(quantile_cont(gap, 0.5), 6) AS median_gap_seconds FROM gaps""")
def cadence(spark, folder):
    return rounded(median_gap(readings(spark, folder), ["pollutant"]), ["median_gap_seconds"])


@query("""SELECT event_id, CAST(hour(ts) AS BIGINT) AS hour,
         CAST(isodow(ts) - 1 AS BIGINT) AS dow, CAST(month(ts) AS BIGINT) AS month
  FROM events""")
def calendar_fields(spark, folder):
    events = table(spark, folder, "events")
    return as_bigint(events.withColumns(calendar(F.col("ts"))), CALENDAR).select(
        "event_id", *CALENDAR
    )


@query(f"""WITH {READINGS}
  SELECT * FROM (
    SELECT pollutant, datetime, value, count(*) OVER f AS n_values,
           round(sum(value) OVER f, 6) AS total,
           first_value(value) OVER f AS oldest, last_value(value) OVER f AS newest
    FROM readings
    WINDOW f AS (PARTITION BY pollutant ORDER BY datetime
                 ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
  WHERE n_values = 30""")
def sequence_windows(spark, folder):
    rows = sequences(
        readings(spark, folder).drop("station_id"), ["pollutant"], ["datetime"], "value", 30
    )
    total = F.aggregate("sequence", F.lit(0.0), lambda acc, v: acc + v)
    return rows.select(
        "pollutant",
        "datetime",
        "value",
        F.size("sequence").cast("bigint").alias("n_values"),
        F.round(total, 6).alias("total"),
        F.element_at("sequence", 1).alias("oldest"),
        F.element_at("sequence", -1).alias("newest"),
    )


@query("""SELECT event_id, ts AS datetime, value FROM events
  WHERE event_type NOT IN ('error', 'view', 'click')""")
def coerce_columns(spark, folder):
    kind = F.col("event_type")
    time = F.when(kind == "error", "no time").otherwise(F.col("ts").cast("string"))
    text = F.col("value").cast("string")
    value = (
        F.when(kind == "view", F.concat(text, F.lit("d")))
        .when(kind == "click", F.replace(text, F.lit("."), F.lit(",")))
        .otherwise(F.concat(F.lit(" "), text))
    )
    rows = table(spark, folder, "events").select(
        "event_id", time.alias("datetime"), value.alias("value")
    )
    return standard_rows(rows)


@query("""SELECT pollutant, count(*) AS n_rows FROM (
    SELECT upper(replace(replace(trim(label), 'PM2,5', 'PM2.5'), 'pm2,5', 'PM2.5')) AS pollutant
    FROM (SELECT concat('  ', event_type, CASE WHEN event_type < 'f' THEN ' PM2,5'
                 WHEN event_type < 'q' THEN ' pm2,5' ELSE ' Pm2,5 ' END) AS label FROM events))
  GROUP BY 1""")
def normalise_labels(spark, folder):
    kind = F.col("event_type")
    end = F.when(kind < "f", " PM2,5").when(kind < "q", " pm2,5").otherwise(" Pm2,5 ")
    label = normal_label(F.concat(F.lit("  "), kind, end))
    return (
        table(spark, folder, "events")
        .groupBy(label.alias("pollutant"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query("SELECT event_id, ts AS datetime, epoch_us(ts) AS micros FROM events")
def zone_roundtrip(spark, folder):
    time = F.col("ts")
    return table(spark, folder, "events").select(
        "event_id",
        instant_to_utc(utc_to_instant(time)).alias("datetime"),
        epoch_micros(time).alias("micros"),
    )


@query(f"""WITH {READINGS},
  stats AS (SELECT pollutant, avg(value) AS mean, stddev_pop(value) + 1e-8 AS std
            FROM readings GROUP BY 1)
  SELECT datetime, pollutant, round((value - mean) / std, 6) AS z, value
  FROM readings JOIN stats USING (pollutant)""")
def standardised(spark, folder):
    rows = readings(spark, folder)
    joined = match_keys(rows, scaler(rows, ["pollutant"]), ["pollutant"], "left")
    z = zscore(F.col("value"), F.col("mean"), F.col("std"))
    back = from_zscore(z, F.col("mean"), F.col("std"))
    return joined.select(
        "datetime", "pollutant", F.round(z, 6).alias("z"), F.round(back, 6).alias("value")
    )


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS position,
         count(*) OVER () AS series_rows
  FROM orders""")
def row_positions(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return with_position(orders, [], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(f"""WITH {READINGS}
  SELECT pollutant, round(quantile_cont(value, 0.05), 6) AS low,
         round(quantile_cont(value, 0.5), 6) AS middle,
         round(quantile_cont(value, 0.95), 6) AS high
  FROM readings GROUP BY 1""")
def value_quantiles(spark, folder):
    found = exact_quantiles(readings(spark, folder), ["pollutant"], "value", [0.05, 0.5, 0.95])
    named = {"low": 0, "middle": 1, "high": 2}
    return found.select(
        "pollutant",
        *[F.round(F.get("quantiles", F.lit(i)), 6).alias(n) for n, i in named.items()],
    )


@query(f"""WITH {READINGS},
  ranked AS (SELECT *, row_number() OVER (
      PARTITION BY station_id ORDER BY datetime DESC) AS r FROM readings)
  SELECT station_id, max(datetime) AS last_time, count(*) AS n_values,
         round(avg(value) FILTER (r BETWEEN 2 AND 8), 6) AS roll_7,
         round(avg(value) FILTER (r BETWEEN 2 AND 25), 6) AS roll_24
  FROM ranked WHERE r <= 30 GROUP BY 1""")
def rolling_state(spark, folder):
    state = history_arrays(readings(spark, folder), ["station_id"], 30)
    history = F.col("__history")
    return state.select(
        "station_id",
        F.col("__last").alias("last_time"),
        F.size(history).cast("bigint").alias("n_values"),
        F.round(mean_before_newest(history, 7), 6).alias("roll_7"),
        F.round(mean_before_newest(history, 24), 6).alias("roll_24"),
    )


@query(f"""WITH {READINGS}
  SELECT station_id, last + to_days(CAST(i AS INTEGER)) AS datetime
  FROM (SELECT station_id, max(datetime) AS last FROM readings GROUP BY 1), range(1, 8) t(i)""")
def future_grid(spark, folder):
    return future_times(readings(spark, folder), ["station_id"], 7, "D")


@query("""SELECT event_type AS pollutant, CAST(p AS DOUBLE) AS p, count(value) AS n_rows,
         true AS within
  FROM events, (VALUES (0.01), (0.25), (0.5), (0.95)) AS t(p) GROUP BY 1, 2""")
def sketch_quantiles(spark, folder):
    """Whether the true ranks of the sketch's quantiles are within its error."""
    rows = readings(spark, folder).select("pollutant", "value")
    shares, error = [0.01, 0.25, 0.5, 0.95], 0.001
    found = quantiles(rows, ["pollutant"], "value", shares, "at", "sketch", error)
    ranked = attach_by_key(rows, found, ["pollutant"])
    pairs = F.arrays_zip(F.array(*map(F.lit, shares)).alias("p"), F.col("at").alias("q"))
    ranked = ranked.select("pollutant", "value", F.inline(pairs).alias("p", "q"))
    counts = ranked.groupBy("pollutant", "p").agg(
        F.count("value").alias("n_rows"),
        F.count_if(F.col("value") < F.col("q")).alias("below"),
        F.count_if(F.col("value") <= F.col("q")).alias("upto"),
    )
    wanted, room = F.col("p") * F.col("n_rows"), F.col("n_rows") * error + 1
    within = (F.col("below") <= wanted + room) & (F.col("upto") >= wanted - room)
    return counts.select("pollutant", "p", "n_rows", within.alias("within"))
