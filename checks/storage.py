"""Sources, sinks and whole jobs (S, K, E rows) on files written from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from checks import query
from checks.aggregates import e2
from checks.bindings import AIR_SQL, HEALTH_SQL, INDEX_SQL, air, health, index, r6, span, table
from checks.learning import HORIZONS, NAIVE_SQL, TARGETS, naive, split_rows
from hazegrid import catalog
from hazegrid.functions.numeric import lookup
from hazegrid.operators import learn, reports, sinks, stats
from hazegrid.plans import analysis, preprocess, training
from hazegrid.session import scratch, stage
from hazegrid.sources import series_files, tables

# Which series a test table stands in for; the name decides feature and cadence.
HOURLY = {
    "view": "M2T1NXAER_5_12_4_TOTSMASS25", "signup": "M2T1NXAER_5_12_4_SO2SMASS", "click": "M2T1NXSLV_5_12_4_TS",
    "error": "M2T1NXSLV_5_12_4_U10M", "purchase": "M2T1NXSLV_5_12_4_V10M",
}
_written: dict = {}


def header_lines(variable, fill):
    """The lines before the data of a series file, as an array."""
    return F.array(
        F.concat(F.lit('Title:,"Area mean of '), variable, F.lit('"')),
        F.lit("User Start Date:,"), F.lit("User End Date:,"), F.lit("User Bounding Box:,"), F.lit("Data Bounding Box:,"), F.lit("URL:,"),
        F.concat(F.lit("Fill Value (mean_"), variable, F.lit("):, "), fill),
        F.lit(""),
        F.concat(F.lit("time, mean_"), variable))


def write_series(df, path: str, fill: str = "1000000000000000") -> None:
    """Write (file, variable, ts, value) as one folder of parts per file; null becomes the fill value."""
    text = F.coalesce(F.col("value").cast("string"), F.lit(fill))
    data = df.select("file", F.concat_ws(",", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), text).alias("value"))
    heads = df.select("file", "variable").distinct().select(
        "file", F.explode(header_lines(F.col("variable"), F.lit(fill))).alias("value"))
    data.unionByName(heads).write.mode("error").partitionBy("file").text(path)


def file_rows(spark, sf_dir):
    """(file, variable, ts, value): events by hour as five hourly series and as rainfall; gaps every midnight."""
    hours = table(spark, sf_dir, "events").groupBy(
        F.col("event_type"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(
        F.round(F.avg("value"), 6).alias("value"))
    token = lookup(F.col("event_type"), HOURLY)
    sensors = hours.select(
        F.concat(F.lit("g4.areaAvgTimeSeries."), token, F.lit(".20240101-20240130.csv")).alias("file"),
        token.alias("variable"), "ts", F.when(F.hour("ts") != 0, F.col("value")).alias("value"))
    second = sensors.filter(F.col("variable") == HOURLY["view"]).withColumn(
        "file", F.regexp_replace("file", "20240101", "20240102")).withColumn("value", F.lit(-1.0))
    rain = hours.filter(F.col("event_type") == "view").select(
        F.lit("hanoi.precipitation.csv").alias("file"), F.lit("rain").alias("variable"), "ts",
        (F.col("value") / 10.0).alias("value"))
    return sensors.unionByName(second).unionByName(rain)


def files(spark, sf_dir) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        _written[key] = scratch(spark, "series")
        write_series(file_rows(spark, sf_dir), _written[key])
    return _written[key]


_FEATURES = {catalog.SERIES[t][0]: e for e, t in HOURLY.items()}
SERIES_SQL = f"""
WITH h AS (SELECT event_type, date_trunc('hour', ts) AS ts, round(avg(value), 6) AS value FROM events GROUP BY 1, 2),
series AS (SELECT CASE event_type {' '.join(f"WHEN '{e}' THEN '{f}'" for f, e in _FEATURES.items())} END AS feature,
  CAST(ts AS TIMESTAMP) AS ts, CASE WHEN hour(ts) <> 0 THEN value END AS value FROM h
  UNION ALL SELECT 'precipitation', CAST(ts AS TIMESTAMP), value / 10e0 FROM h WHERE event_type = 'view')
"""


@query("S1_series_files", SERIES_SQL + "SELECT feature, ts, round(coalesce(value, 1e15), 6) AS value FROM series")
def read_series(spark, sf_dir):
    raw = series_files.read_series(spark, files(spark, sf_dir))
    return r6(raw.select("feature", "ts", "value"))


@query("S2_declared_fill_values", SERIES_SQL + """SELECT feature, count(*) AS n, count(*) - count(value) AS filled,
  1e15 AS fill_value FROM series GROUP BY feature""")
def declared_fill_values(spark, sf_dir):
    raw = series_files.read_series(spark, files(spark, sf_dir))
    return raw.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") == F.col("fill_value")).alias("filled"),
        F.max("fill_value").alias("fill_value"))


@query("S3_files_of_features", f"""SELECT * FROM (VALUES {', '.join(
    f"('{catalog.SERIES[t][0]}', 'g4.areaAvgTimeSeries.{t}.20240101-20240130.csv')" for t in HOURLY.values())},
    ('PM2_5', 'g4.areaAvgTimeSeries.{HOURLY['view']}.20240102-20240130.csv'),
    ('precipitation', 'hanoi.precipitation.csv')) t(feature, file)""")
def files_of_features(spark, sf_dir):
    return series_files.known_files(series_files.list_files(spark, files(spark, sf_dir))).select("feature", "file")


@query("S4_cadence_of_series", SERIES_SQL + """SELECT feature, count(*) AS n_rows, CASE WHEN feature = 'precipitation'
  AND NOT bool_or(ts <> date_trunc('day', ts)) THEN 'daily' ELSE 'hourly' END AS resolution FROM series GROUP BY feature""")
def cadence_of_series(spark, sf_dir):
    return series_files.cadence(series_files.read_series(spark, files(spark, sf_dir)))


_LAYOUT = ("date", "year", "month", "season", "PM2_5", "aqi", "aqi_category")


@query("S5_processed_csv", INDEX_SQL + f"SELECT {', '.join(_LAYOUT)} FROM aqi_data")
def processed_csv(spark, sf_dir):
    path = scratch(spark, "csv")
    sinks.write_table(index(spark, sf_dir).select(*_LAYOUT), path, "csv")
    return tables.read_daily(spark, path, _LAYOUT)


@query("S6_sql_tables", HEALTH_SQL + """SELECT a.season, count(*) AS days, round(avg(a.aqi), 6) AS avg_aqi,
  round(avg(h.total_cases), 6) AS avg_cases FROM aqi_data a JOIN health_data h USING (date) GROUP BY a.season""")
def sql_tables(spark, sf_dir):
    tables.register(spark, aqi_data=index(spark, sf_dir), health_data=health(spark, sf_dir))
    return spark.sql("""
        SELECT a.season, count(*) AS days, round(avg(a.aqi), 6) AS avg_aqi, round(avg(h.total_cases), 6) AS avg_cases
        FROM aqi_data a JOIN health_data h USING (date) GROUP BY a.season""")


_MODEL_SQL = NAIVE_SQL + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY overall_r2_test DESC,
  model) AS rank FROM score)
SELECT horizon, 'model' || rank AS model_idx, model AS model_name, 'PM10' AS features, 'PM2_5,wind_u10m' AS targets,
  round(overall_r2_test, 4) AS overall_r2_test, round(overall_rmse_test, 4) AS overall_rmse_test, aqi_r2_test,
  (SELECT count(*) FROM split WHERE split = 'train') AS train_size,
  (SELECT count(*) FROM split WHERE split = 'test') AS test_size FROM ranked"""


def _model_metadata(spark, sf_dir):
    path = scratch(spark, "metadata")
    board = learn.leaderboard(learn.weighted_scores(learn.metrics(naive(spark, sf_dir))))
    sinks.write_json(training.metadata(board, ["PM10"], TARGETS, split_rows(spark, sf_dir)), path)
    return path


def _flat(df):
    return r6(df.select(
        "horizon", "model_idx", "model_name", F.array_join("feature_names", ",").alias("features"),
        F.array_join("targets", ",").alias("targets"), "overall_r2_test", "overall_rmse_test", "aqi_r2_test",
        "train_size", "test_size"), digits=4)


@query("S7_model_metadata", _MODEL_SQL)
def model_metadata(spark, sf_dir):
    # One document per file, as models are described one by one.
    path = scratch(spark, "documents")
    lines = spark.read.text(_model_metadata(spark, sf_dir))
    lines.repartition(6, "value").write.option("maxRecordsPerFile", 1).text(path)
    return _flat(tables.read_model_metadata(spark, path))


@query("K1_two_checkpoints", INDEX_SQL + f"""SELECT 'before' AS state, {', '.join(_LAYOUT)} FROM aqi_data
UNION ALL SELECT 'after', {', '.join(_LAYOUT)} FROM aqi_data""")
def two_checkpoints(spark, sf_dir):
    df = index(spark, sf_dir).select(*_LAYOUT)
    before, after = scratch(spark, "before"), scratch(spark, "after")
    sinks.write_table(df, before, "csv")
    sinks.write_table(df, after)
    states = [tables.read_daily(spark, before, _LAYOUT).select(F.lit("before").alias("state"), "*"),
              tables.read_daily(spark, after).select(F.lit("after").alias("state"), "*")]
    return states[0].unionByName(states[1])


@query("K2_replaced_table", INDEX_SQL + "SELECT date, aqi, aqi_category FROM aqi_data")
def replaced_table(spark, sf_dir):
    name = "hazegrid_index"
    sinks.replace_table(index(spark, sf_dir).select("date"), name, scratch(spark, "table"))
    # The second one meets the first.
    sinks.replace_table(index(spark, sf_dir).select("date", "aqi", "aqi_category"), name, scratch(spark, "table"))
    return spark.table(name)


@query("K2_table_from_itself", INDEX_SQL + "SELECT date, aqi, CAST(year(date) AS INTEGER) AS year FROM aqi_data WHERE aqi IS NOT NULL")
def table_from_itself(spark, sf_dir):
    """The table is replaced by rows that are read from it."""
    name, place = "hazegrid_own", scratch(spark, "table")
    sinks.replace_table(index(spark, sf_dir).select("date", "aqi", "aqi_category"), name, place)
    sinks.replace_table(spark.table(name).filter("aqi IS NOT NULL").select("date", "aqi", F.year("date").alias("year")), name, place)
    return spark.table(name)


@query("K3_appended_results", AIR_SQL + f""", c AS (SELECT series, year, avg(aqi) AS m FROM air GROUP BY 1, 2)
SELECT 'trend' AS analysis_type, (SELECT count(*) FROM (SELECT DISTINCT year FROM air)) AS n,
  (SELECT {e2('avg(aqi)')} FROM air WHERE year = 1997) AS sample
UNION ALL SELECT 'seasons', 4, (SELECT {e2('avg(aqi)')} FROM air WHERE season = 2)""")
def appended_results(spark, sf_dir):
    path, df = scratch(spark, "results"), air(spark, sf_dir)
    parts = {
        "trend": sinks.records_json(stats.yearly_index(df), "year"),
        "seasons": sinks.records_json(stats.season_stats(df), "season")}
    for kind, result in parts.items():
        sinks.append_result(sinks.analysis_row(result, kind, F.lit(kind)), path)
    saved = spark.read.parquet(path)
    sample = F.when(F.col("analysis_type") == "trend", F.get_json_object("results_json", "$.1997.mean")).otherwise(
        F.get_json_object("results_json", "$.2.aqi_mean"))
    return saved.select("analysis_type", F.size(F.json_object_keys("results_json")).cast("long").alias("n"),
                        sample.cast("double").alias("sample"))


_TRENDS_SQL = AIR_SQL + f"""SELECT year, {e2('avg(aqi)')} AS aqi_avg, {e2('max(aqi)')} AS aqi_max,
  {e2('min(aqi)')} AS aqi_min, {e2('avg(PM2_5)')} AS pm2_5_avg, {e2('avg(PM10)')} AS pm10_avg,
  {e2('avg(temperature_mean)')} AS temperature_avg, {e2('avg(humidity)')} AS humidity_avg,
  {e2('avg(wind_speed)')} AS wind_speed_avg FROM air GROUP BY year"""


@query("K4_refreshed_years", _TRENDS_SQL)
def refreshed_years(spark, sf_dir):
    """First a table in which the last years are those of January alone, then these years anew."""
    path, df = scratch(spark, "trends"), air(spark, sf_dir)
    late = F.col("year") >= 1996
    sinks.refresh_trends(df.filter(~late | (F.col("month") == 1)), path)
    sinks.refresh_trends(df.filter(late), path)
    return spark.read.parquet(path)


@query("K4_reloaded_trends", _TRENDS_SQL)
def reloaded_trends(spark, sf_dir):
    path = scratch(spark, "trends")
    sinks.reload_trends(air(spark, sf_dir).limit(0), path)
    sinks.reload_trends(air(spark, sf_dir), path)
    return spark.read.parquet(path)


@query("K5_flat_json", AIR_SQL + f"""SELECT aqi_category, {e2('avg(PM2_5)')} AS pm25, {e2('max(aqi)')} AS top,
  count(PM2_5) = 0 AS no_pm25 FROM air GROUP BY aqi_category""")
def flat_json(spark, sf_dir):
    by_category = stats.grouped_stats(air(spark, sf_dir), "aqi_category", {
        "PM2_5_mean": F.avg("PM2_5"), "aqi_max": F.max("aqi")})
    flat = sinks.records_json(by_category, "aqi_category")
    kind = "map<string, struct<PM2_5_mean: double, aqi_max: double>>"
    return flat.select(F.explode(F.from_json("results_json", kind))).select(
        F.col("key").alias("aqi_category"), F.col("value.PM2_5_mean").alias("pm25"),
        F.col("value.aqi_max").alias("top"), F.col("value.PM2_5_mean").isNull().alias("no_pm25"))


@query("K6_dataset_metadata", INDEX_SQL + """SELECT count(*) AS records, CAST(min(date) AS VARCHAR) AS date_min,
  CAST(max(date) AS VARCHAR) AS date_max FROM aqi_data""")
def dataset_metadata(spark, sf_dir):
    path = scratch(spark, "facts")
    sinks.write_json(sinks.dataset_metadata(index(spark, sf_dir)), path)
    return spark.read.schema("records long, date_min string, date_max string").json(path)


@query("K7_model_metrics", _MODEL_SQL)
def model_metrics(spark, sf_dir):
    return _flat(tables.read_model_metadata(spark, _model_metadata(spark, sf_dir), documents=False))


# --- whole jobs --------------------------------------------------------------------------------------------

def raw_series(spark, sf_dir):
    """Lineitem by day (dew point by month) as the series of two stations, one per line status."""
    li = table(spark, sf_dir, "lineitem")
    roles = {
        "PM2_5": F.col("l_quantity") * 1.3e-9, "NO2_trop": F.col("l_extendedprice") * 1e11,
        "SO2_column": F.col("l_discount") * 12.0, "O3": F.col("l_quantity") * 9.0, "CO": F.col("l_tax") * 7000.0,
        "temperature_mean": F.col("l_quantity") * 0.3 + 285.0, "wind_u10m": F.col("l_discount") * 100.0 - 5.0,
        "wind_v10m": F.col("l_tax") * 100.0 - 4.0}
    tall = li.select(F.col("l_linestatus").alias("station"), F.col("l_shipdate").alias("ts"), F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), v.alias("value")) for f, v in roles.items()])))
    daily = tall.groupBy("station", "feature", "ts").agg(F.avg("value").alias("value"))
    dew = li.groupBy(F.col("l_linestatus").alias("station"), F.date_trunc("month", "l_shipdate").alias("ts")).agg(
        (F.avg("l_quantity") * 0.25 + 280.0).alias("value")).select(
        "station", F.lit("dew_point").alias("feature"), F.col("ts").cast("timestamp_ntz").alias("ts"), "value")
    return daily.unionByName(dew)


RESOLUTIONS = {"PM2_5": "daily", "NO2_trop": "daily", "SO2_column": "daily", "O3": "daily", "CO": "daily",
               "temperature_mean": "daily", "wind_u10m": "daily", "wind_v10m": "daily", "dew_point": "monthly"}
_tables: dict = {}


def processed(spark, sf_dir):
    """The finished daily table of both stations, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _tables:
        raw = stage(raw_series(spark, sf_dir), "series")
        _, done = preprocess.daily_table(
            raw, ["station"], RESOLUTIONS, *span(spark, sf_dir, "lineitem", "l_shipdate"))
        _tables[key] = stage(done, "processed")
    return _tables[key]


@query("E1_preprocess")
def preprocess_job(spark, sf_dir):
    return processed(spark, sf_dir)


@query("E1_preprocess_files")
def preprocess_files(spark, sf_dir):
    """From text files to the daily table."""
    return preprocess.preprocess(spark, files(spark, sf_dir), "2024-01-01", "2024-01-30")[1]


@query("E2_analyses")
def analyses(spark, sf_dir):
    return analysis.all_results(processed(spark, sf_dir))


@query("E2_chart_tables")
def chart_tables(spark, sf_dir):
    """All numbers of all charts, one a row: (chart, key, measure, value)."""
    parts = []
    for name, df in analysis.charts(processed(spark, sf_dir)).items():
        numbers = [c for c, t in df.dtypes if t == "double"]
        key = F.concat_ws("|", *[F.col(c).cast("string") for c in df.columns if c not in numbers])
        parts.append(df.select(F.lit(name).alias("chart"), key.alias("key"), F.inline(F.array(*[
            F.struct(F.lit(c).alias("measure"), F.col(c).alias("value")) for c in numbers]))))
    return reduce(DataFrame.unionByName, parts)


@query("E3_train_and_rank")
def train_and_rank(spark, sf_dir):
    """All targets, horizons and learners; trees are fewer and lower than the operator's own."""
    frame, features, targets = training.prepared(processed(spark, sf_dir), ["station"])
    _, _, board = training.train_and_rank(frame, features, targets, trees=10, depth=6, rounds=3, round_depth=3)
    return board


@query("E1_facts", """WITH d AS (SELECT l_linestatus AS station, CAST(l_shipdate AS DATE) AS date FROM lineitem),
s AS (SELECT min(date) AS first_date, max(date) AS last_date FROM d)
SELECT station, CAST(last_date - first_date + 1 AS BIGINT) AS n_rows, first_date, last_date,
  CAST(last_date - first_date + 1 AS BIGINT) AS n_dates, true AS complete, true AS banded
FROM s, (SELECT DISTINCT station FROM d)""")
def preprocess_facts(spark, sf_dir):
    """What must hold of the finished table: every day once, no gaps in what had values, an index and its band on all rows."""
    df = processed(spark, sf_dir)
    measures = [c for c in catalog.POLLUTANTS + catalog.WEATHER + catalog.DERIVED if c in df.columns]
    whole = F.lit(True)
    for c in measures:
        whole = whole & (F.count(c) == F.count(F.lit(1)))
    banded = F.bool_and(F.col("aqi").between(0, 500) & (F.col("aqi_category") != catalog.UNKNOWN))
    return df.groupBy("station").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count_distinct("date").alias("n_dates"), whole.alias("complete"), banded.alias("banded"))


@query("E2_saved_results", AIR_SQL + """SELECT 'results' AS kind, 5 AS n UNION ALL SELECT 'trends', count(DISTINCT year) FROM air""")
def saved_results(spark, sf_dir):
    folder = scratch(spark, "saved")
    analysis.save(air(spark, sf_dir), folder)
    return spark.read.parquet(f"{folder}/results").agg(F.count(F.lit(1)).alias("n")).select(F.lit("results").alias("kind"), "n").unionByName(
        spark.read.parquet(f"{folder}/trends").agg(F.count(F.lit(1)).alias("n")).select(F.lit("trends").alias("kind"), "n"))
