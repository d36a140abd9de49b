"""Reading, selecting, reshaping and writing tables."""

from pyspark.sql import functions as F

from catalog.registry import (
    DAILY,
    HOURLY,
    READINGS,
    daily,
    hourly,
    naive,
    naive_forecast,
    query,
    readings,
    rounded,
    table,
)
from lagline.functions.clean import with_times
from lagline.operators.filters import (
    by_history_length,
    history_tail as newest_rows,
    matching_text,
    only_normal_pollutant,
    only_pollutant,
)
from lagline.operators.metrics import regression_metrics
from lagline.operators.reshape import station_names, wide_to_long
from lagline.plans.features import featurise_files
from lagline.session import scratch_path
from lagline.sources.columns import measure_candidates, measure_counts
from lagline.sources.sinks import log_run, read_runs, write_json_records, write_parquet
from lagline.sources.tables import (
    land_csv,
    load_daily,
    load_hourly,
    load_predictions,
    load_training,
    load_truth,
    read_tables,
)

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DATED = ("date", "timestamp")


@query("SELECT * FROM customer UNION ALL BY NAME SELECT * FROM supplier")
def union_scan(spark, folder):
    names = ["customer", "no_such_table", "supplier"]
    return read_tables(spark, [f"{folder}/{n}.parquet" for n in names])


@query("""SELECT event_type AS pollutant, ts AS datetime, value AS forecast FROM events
  WHERE event_type <> 'error'""")
def prediction_source(spark, folder):
    kind = F.col("event_type")
    text = F.when(kind == "error", "n/a").otherwise(F.col("value").cast("string"))
    rows = table(spark, folder, "events").select(
        kind.alias("pollutant"), F.col("ts").alias("Valid_Time"), text.alias("yhat")
    )
    return load_predictions(rows)


@query("""SELECT o_orderpriority, o_orderdate AS datetime, o_totalprice AS value FROM orders""")
def training_load(spark, folder):
    orders = table(spark, folder, "orders")
    return load_training(
        orders.select(
            "o_orderpriority",
            F.col("o_orderdate").alias("Date"),
            F.col("o_totalprice").cast("string").alias("Indice"),
        )
    )


@query("""SELECT o_orderpriority, o_orderdate AS datetime, o_totalprice AS value FROM orders""")
def daily_load(spark, folder):
    orders = table(spark, folder, "orders")
    return load_daily(
        orders.select(
            "o_orderpriority",
            F.col("o_orderdate").cast("string").alias("observed_date"),
            F.col("o_totalprice").alias("mean_iqa"),
        )
    )


@query(f"WITH {DAILY} SELECT pollutant, datetime, round(value, 9) AS value FROM daily")
def truth_source(spark, folder):
    named = daily(spark, folder).withColumnsRenamed({"datetime": "date", "value": "iqa"})
    truth = load_truth(named.withColumn("note", F.lit(None).cast("string")), ["pollutant"])
    return rounded(truth, ["value"], 9)


@query(f"""WITH {HOURLY}
  SELECT datetime, CASE pollutant WHEN 'click' THEN 'PM2.5' ELSE upper(pollutant) END AS pollutant,
         value
  FROM hourly""")
def hourly_load(spark, folder):
    hours = hourly(spark, folder)
    kinds = [r[0] for r in hours.select("pollutant").distinct().orderBy("pollutant").collect()]
    wide = hours.groupBy("datetime").pivot("pollutant", kinds)
    named = wide.agg(F.first("value")).withColumnsRenamed(
        {"datetime": "reading_time", "click": "pm2,5"}
    )
    return load_hourly(named.withColumn("site", F.lit("7")))


@query("""SELECT count(l_orderkey) AS l_orderkey, count(l_partkey) AS l_partkey,
         count(l_suppkey) AS l_suppkey, count(l_linenumber) AS l_linenumber,
         count(l_quantity) AS l_quantity, count(l_extendedprice) AS l_extendedprice,
         count(l_discount) AS l_discount, count(l_tax) AS l_tax,
         count(TRY_CAST(l_returnflag AS DOUBLE)) AS l_returnflag,
         count(TRY_CAST(l_linestatus AS DOUBLE)) AS l_linestatus
  FROM lineitem""")
def detect_measures(spark, folder):
    items = table(spark, folder, "lineitem")
    times = [f.name for f in items.schema.fields if f.dataType.typeName().startswith(DATED)]
    return measure_counts(items, measure_candidates(items, times))


@query(f"WITH {READINGS} SELECT * FROM readings WHERE pollutant = 'click'")
def pollutant_filter(spark, folder):
    return only_pollutant(readings(spark, folder), "click")


@query(f"WITH {READINGS} SELECT * FROM readings WHERE upper(trim(pollutant)) = 'CLICK'")
def pollutant_filter_normal(spark, folder):
    return only_normal_pollutant(readings(spark, folder), " Click ")


@query("SELECT * FROM customer WHERE regexp_matches(c_name, 'customer#0*[13579]+$', 'i')")
def station_regex(spark, folder):
    return matching_text(table(spark, folder, "customer"), "c_name", "customer#0*[13579]+$")


@query(f"""WITH {READINGS}
  SELECT * FROM readings
  QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY datetime DESC) <= 30""")
def history_tail(spark, folder):
    return newest_rows(readings(spark, folder), ["station_id"], 30)


@query(f"""WITH {READINGS}
  SELECT station_id, count(*) AS history_rows FROM readings
  GROUP BY 1 HAVING count(*) < 70""")
def short_history(spark, folder):
    return by_history_length(readings(spark, folder), ["station_id"], 70)[1]


@query(f"""WITH {READINGS}
  SELECT * FROM readings
  WHERE station_id IN (SELECT station_id FROM readings GROUP BY 1 HAVING count(*) >= 70)""")
def enough_history(spark, folder):
    return by_history_length(readings(spark, folder), ["station_id"], 70)[0]


@query(" UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, l_shipdate, '{m}' AS pollutant, {m} AS value FROM lineitem"
    for m in MEASURES
))
def unpivot_measures(spark, folder):
    ids = ["l_orderkey", "l_linenumber", "l_shipdate"]
    return wide_to_long(table(spark, folder, "lineitem"), ids, MEASURES)


@query("""SELECT DISTINCT station FROM (
    SELECT c_name AS station FROM customer UNION ALL
    SELECT CAST(c_nationkey AS VARCHAR) FROM customer) ORDER BY 1""")
def station_list(spark, folder):
    customers = table(spark, folder, "customer").withColumnsRenamed(
        {"c_name": "Station_name", "c_nationkey": "code_station"}
    )
    return station_names(customers)


@query(f"WITH {HOURLY}, {naive('hourly')} SELECT pollutant, datetime, forecast FROM pairs")
def parquet_sink(spark, folder):
    rows = naive_forecast(hourly(spark, folder)).drop("value")
    return spark.read.parquet(write_parquet(rows, scratch_path(spark, "forecast")))


@query(f"""WITH {HOURLY}, {naive('hourly')}
  SELECT pollutant, strftime(datetime, '%Y-%m-%d %H:%M:%S+00:00') AS datetime, forecast
  FROM pairs""")
def json_records(spark, folder):
    rows = naive_forecast(hourly(spark, folder)).drop("value")
    path = write_json_records(rows, scratch_path(spark, "records"))
    return spark.read.schema("pollutant string, datetime string, forecast double").json(path)


@query("SELECT * FROM orders")
def csv_landing(spark, folder):
    orders = table(spark, folder, "orders")
    raw = scratch_path(spark, "raw")
    orders.write.csv(raw, header=True)
    return land_csv(spark, raw, scratch_path(spark, "landed"), orders.schema)


@query(f"""WITH {HOURLY}, {naive('hourly')}
  SELECT 'train' AS kind, 'naive' AS model, round(avg(abs(value - forecast)), 6) AS mae,
         round(sqrt(avg((value - forecast) ** 2)), 6) AS rmse FROM pairs""")
def run_log(spark, folder):
    log = scratch_path(spark, "runs")
    metrics = regression_metrics(naive_forecast(hourly(spark, folder))).first().asDict()
    log_run(spark, log, "train", {"model": "naive"}, metrics)
    runs = read_runs(spark, log).select(
        "kind",
        F.col("params")["model"].alias("model"),
        F.col("metrics")["mae"].alias("mae"),
        F.col("metrics")["rmse"].alias("rmse"),
    )
    return rounded(runs, ["mae", "rmse"])


@query(f"""WITH sites AS (
    SELECT date_trunc('hour', ts) AS datetime, 'Site ' || event_type AS station_name,
           'NO2' AS pollutant, max(value) AS value
    FROM events GROUP BY 1, 2),
  lagged AS (
    SELECT *, lag(value, 1) OVER w AS lag_1, lag(value, 24) OVER w AS lag_24,
           lead(value) OVER w AS target
    FROM sites WINDOW w AS (PARTITION BY station_name ORDER BY datetime))
  SELECT station_name, count(*) AS n_rows, round(sum(lag_1), 4) AS lag_1,
         round(sum(lag_24), 4) AS lag_24, round(sum(target), 4) AS target
  FROM lagged WHERE lag_24 IS NOT NULL AND target IS NOT NULL
    AND regexp_matches(station_name, 'site (click|view)', 'i')
  GROUP BY 1""")
def featurise_two_files(spark, folder):
    sites = hourly(spark, folder).select(
        "datetime",
        F.concat(F.lit("Site "), "pollutant").alias("station_name"),
        F.lit("NO2").alias("pollutant"),
        "value",
    )
    middle = "timestamp_ntz'2024-01-16 00:00:00'"
    paths = [
        write_parquet(sites.where(part), scratch_path(spark, "part"))
        for part in (f"datetime < {middle}", f"datetime >= {middle}")
    ]
    out = scratch_path(spark, "features")
    built = featurise_files(spark, paths, out, "SITE (click|view)", "NO2")
    sums = [F.round(F.sum(c), 4).alias(c) for c in ("lag_1", "lag_24", "target")]
    return built.frame.groupBy("station_name").agg(F.count(F.lit(1)).alias("n_rows"), *sums)


LAYOUTS = {
    "iso": ("yyyy-MM-dd'T'HH:mm:ss", ""),
    "iso_z": ("yyyy-MM-dd'T'HH:mm:ss", "Z"),
    "hours_ahead": ("yyyy-MM-dd HH:mm:ss", "+04"),
    "hours_behind": ("yyyy-MM-dd HH:mm:ss", "-0330"),
    "with_colon": ("yyyy-MM-dd HH:mm:ss", " +04:00"),
    "slashes": ("yyyy/MM/dd HH:mm:ss", "+00"),
    "month_first": ("MM/dd/yyyy HH:mm", " utc"),
    "compact": ("yyyyMMdd", ""),
    "unknown_zone": ("yyyy-MM-dd HH:mm:ss", " EST"),
    "zone_on_a_date": ("yyyy-MM-dd", "+04"),
}


@query("""SELECT event_id, date_trunc('second', ts) AS iso, date_trunc('second', ts) AS iso_z,
         date_trunc('second', ts) - INTERVAL 4 HOUR AS hours_ahead,
         date_trunc('second', ts) + INTERVAL 210 MINUTE AS hours_behind,
         date_trunc('second', ts) - INTERVAL 4 HOUR AS with_colon,
         date_trunc('second', ts) AS slashes, date_trunc('minute', ts) AS month_first,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS compact,
         CAST(NULL AS TIMESTAMP) AS unknown_zone, CAST(NULL AS TIMESTAMP) AS zone_on_a_date
  FROM events""")
def parse_times(spark, folder):
    """Times written in each layout and read again."""
    texts = table(spark, folder, "events").select(
        "event_id",
        *[
            F.concat(F.date_format("ts", layout), F.lit(zone)).alias(name)
            for name, (layout, zone) in LAYOUTS.items()
        ],
    )
    return with_times(texts, LAYOUTS)
