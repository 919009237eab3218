"""Cleaning, filters and resampling (C, R, J1 rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import query
from checks.bindings import (
    AIR_SQL, CATEGORY_SQL, CELLS_SQL, DENSE_SQL, INDEX_SQL, SINCE, air, cells, dense, index, line_sql, order_days,
    r6, span, spine_sql, table,
)
from hazegrid import catalog
from hazegrid.functions import air as air_fn
from hazegrid.functions.numeric import clip
from hazegrid.operators import clean, gapfill, join, resample
from checks.bindings import day


# Events as raw sensor readings: the last hour of a day carries a fill value that
# differs by sensor: huge and exact, huge and near, or small.

def readings(spark, sf_dir):
    """(event_id, feature, ts, value, fill_value) with sentinels in the last hour of each day."""
    events = table(spark, sf_dir, "events")
    late = F.hour("ts") == 23
    kind = F.col("event_type")
    fill = (F.when(kind == "view", F.lit(-1e30)).when(kind == "purchase", F.lit(-999.0)).otherwise(F.lit(1e15)))
    near = F.when(kind == "error", fill * 1.004).otherwise(fill)
    return events.select(
        "event_id", kind.alias("feature"), "ts",
        F.when(late, near).otherwise(F.col("value")).alias("value"), fill.alias("fill_value"))


READINGS_SQL = """
WITH readings AS (SELECT event_id, event_type AS feature, ts,
  CASE WHEN hour(ts) = 23 THEN CASE event_type WHEN 'view' THEN -1e30 WHEN 'purchase' THEN -999e0
    WHEN 'error' THEN 1e15 * 1.004e0 ELSE 1e15 END ELSE value END AS value,
  CASE event_type WHEN 'view' THEN -1e30 WHEN 'purchase' THEN -999e0 ELSE 1e15 END AS fill_value FROM events),
exact AS (SELECT * REPLACE (CASE WHEN abs(fill_value) > 1e6 AND value = fill_value THEN NULL
  WHEN abs(fill_value) <= 1e6 AND abs(value - fill_value) <= 1e-10 + 1e-10 * abs(fill_value) THEN NULL
  ELSE value END AS value) FROM readings)
"""


@query("C1_sentinel_to_null", READINGS_SQL + "SELECT event_id, feature, value FROM exact")
def sentinel_to_null(spark, sf_dir):
    return readings(spark, sf_dir).select(
        "event_id", "feature", clean.drop_sentinels(F.col("value"), F.col("fill_value")).alias("value"))


@query("C2_near_sentinel_sweep", READINGS_SQL + """, rate AS (SELECT feature,
  count(*) FILTER (WHERE abs(value) > 1e12 OR value < -1e15) * 100e0 / count(value) > 0.1 AS sweep FROM exact GROUP BY 1)
SELECT event_id, feature, CASE WHEN sweep AND abs(fill_value) > 1e10 AND (abs(value) > 1e12 OR value < -1e15)
  AND abs(value - fill_value) <= 0.01 * abs(fill_value) THEN NULL ELSE value END AS value
FROM exact JOIN rate USING (feature)""")
def near_sentinel_sweep(spark, sf_dir):
    exact = readings(spark, sf_dir).withColumn("value", clean.drop_sentinels(F.col("value"), F.col("fill_value")))
    return clean.sweep_near_sentinels(exact, ["feature"]).select("event_id", "feature", "value")


@query("C3_outlier_report", """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1,
  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
n AS (SELECT event_type, q1, q3, count(*) FILTER (WHERE value < q1 - 3 * (q3 - q1) OR value > q3 + 3 * (q3 - q1))
  AS outliers, count(*) AS valid FROM events JOIN q USING (event_type) GROUP BY 1, 2, 3)
SELECT event_type, round(q1, 6) AS q1, round(q3, 6) AS q3, outliers, valid,
  round(outliers * 100e0 / valid, 6) AS outlier_pct FROM n WHERE outliers * 100e0 / valid > 0.5""")
def outlier_report(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return r6(clean.outlier_report(events, ["event_type"], "value", above_pct=0.5))


@query("C4_valid_ratio", CELLS_SQL + """SELECT series, count(*) AS total, count(value) AS valid,
  round(count(value) * 100e0 / count(*), 6) AS valid_pct FROM cells GROUP BY series""")
def valid_ratio(spark, sf_dir):
    return r6(clean.valid_ratio(cells(spark, sf_dir), ["series"]))


@query("C5_lower_date_bound", """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-10-01'""")
def lower_date_bound(spark, sf_dir):
    return clean.from_date(table(spark, sf_dir, "orders"), "o_orderdate", "1998-10-01").select(
        "o_orderkey", "o_orderdate", "o_totalprice")


@query("C6_late_starts", """WITH f AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'NO2_trop' WHEN 'O' THEN 'CO' ELSE 'skin_temperature' END
    AS feature, c_nationkey, o_orderdate
  FROM orders JOIN customer ON o_custkey = c_custkey),
s AS (SELECT feature || '|' || c_nationkey AS feature, feature AS name, min(CAST(o_orderdate AS DATE)) AS first_date
  FROM f GROUP BY 1, 2)
SELECT name, feature AS series, first_date, CASE name WHEN 'CO' THEN 'Vệ tinh AIRS bắt đầu hoạt động từ 2002-08-31'
  WHEN 'skin_temperature' THEN NULL ELSE 'Vệ tinh OMI bắt đầu hoạt động từ 2004-10-01' END AS reason
FROM s WHERE first_date > DATE '1995-01-05'""")
def late_starts(spark, sf_dir):
    raw = order_days(spark, sf_dir)
    name = clean.lookup(F.substring_index("series", "|", -1), {
        "F": "NO2_trop", "O": "CO", "P": "skin_temperature"})
    named = raw.select(F.concat_ws("|", name, F.substring_index("series", "|", 1)).alias("series"), "ts")
    firsts = clean.late_starts(named, "series", "ts", "1995-01-05", {})
    return firsts.select(
        F.substring_index("series", "|", 1).alias("name"), "series", "first_date").select(
        "*", clean.lookup(F.col("name"), catalog.MISSING_REASONS).alias("reason"))


@query("C7_range_invalidation", AIR_SQL + """SELECT l_orderkey, l_linenumber, date,
  CASE WHEN PM2_5 BETWEEN 0 AND 450 THEN PM2_5 END AS PM2_5, CASE WHEN O3 BETWEEN 0 AND 400 THEN O3 END AS O3,
  CASE WHEN SO2_column BETWEEN 0 AND 1 THEN SO2_column END AS SO2_column FROM air""")
def range_invalidation(spark, sf_dir):
    ranges = {"PM2_5": (0.0, 450.0), "O3": (0.0, 400.0), "SO2_column": catalog.RANGES["SO2_column"]}
    return air(spark, sf_dir).select("l_orderkey", "l_linenumber", "date", *[
        F.when(~gapfill.out_of_range(c, ranges), F.col(c)).alias(c) for c in ranges])


@query("C8_clip", AIR_SQL + """SELECT l_orderkey, l_linenumber, date, CASE WHEN PM2_5 IS NULL THEN NULL
  ELSE least(greatest(PM2_5, 10e0), 350e0) END AS PM2_5, least(greatest(wind_u10m, -2e0), 2e0) AS wind_u10m FROM air""")
def clip_values(spark, sf_dir):
    return air(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "date", clip(F.col("PM2_5"), 10.0, 350.0).alias("PM2_5"),
        clip(F.col("wind_u10m"), -2.0, 2.0).alias("wind_u10m"))


_PROFILED = ["PM2_5", "PM10", "wind_u10m", "wind_v10m", "wind_speed"]


@query("C9_missing_profile", DENSE_SQL + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
    round((count(*) - count({c})) * 100e0 / count(*), 6) AS missing_pct FROM dense""" for c in _PROFILED))
def missing_profile(spark, sf_dir):
    return r6(clean.missing_profile(dense(spark, sf_dir), _PROFILED))


@query("C9_completeness", DENSE_SQL + f"""SELECT count(*) AS n_rows, count(*) * 5 AS cells,
  count(*) * 5 - ({' + '.join(f'count({c})' for c in _PROFILED)}) AS missing_cells,
  count(*) FILTER (WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _PROFILED)}) AS complete_rows,
  count(*) FILTER (WHERE {' OR '.join(f'{c} IS NULL' for c in _PROFILED)}) AS incomplete_rows FROM dense""")
def completeness(spark, sf_dir):
    return clean.completeness(dense(spark, sf_dir), _PROFILED)


@query("C10_recent_rows", INDEX_SQL + f"SELECT date, year, aqi FROM aqi_data WHERE year >= {SINCE}")
def recent_rows(spark, sf_dir):
    return index(spark, sf_dir).filter(F.col("year") >= SINCE).select("date", "year", "aqi")


@query("C11_complete_pairs", AIR_SQL + """SELECT l_orderkey, l_linenumber, PM2_5, SO2_column FROM air
WHERE PM2_5 IS NOT NULL AND SO2_column IS NOT NULL""")
def complete_pairs(spark, sf_dir):
    return air(spark, sf_dir).dropna(subset=["PM2_5", "SO2_column"]).select(
        "l_orderkey", "l_linenumber", "PM2_5", "SO2_column")


@query("C12_mean_fill", AIR_SQL + """SELECT l_orderkey, l_linenumber,
  round(coalesce(PM2_5, (SELECT avg(PM2_5) FROM air)), 6) AS PM2_5,
  round(coalesce(SO2_column, (SELECT avg(SO2_column) FROM air)), 6) AS SO2_column FROM air""")
def mean_fill(spark, sf_dir):
    filled = clean.fill_with_means(air(spark, sf_dir), ["PM2_5", "SO2_column"])
    return r6(filled.select("l_orderkey", "l_linenumber", "PM2_5", "SO2_column"))


@query("C13_ordered_projection", AIR_SQL + """SELECT date, year, month, day, weekday, day_of_year, is_weekend, season,
  AOD_550, PM2_5, PM10, O3, CO, round(humidity, 6) AS humidity, l_orderkey FROM air""")
def ordered_projection(spark, sf_dir):
    df = air(spark, sf_dir).drop("series", "l_linenumber", "NO2_trop", "NO2_total", "SO2_column", "SO2_surface",
                                 "temperature_mean", "dew_point", "wind_u10m", "wind_v10m", "wind_speed",
                                 "aqi", "aqi_category")
    return r6(df.select(*clean.in_order(df.columns, catalog.DAILY_COLUMNS)), "humidity")


@query("C14_point_lookup", INDEX_SQL + """SELECT date, aqi, aqi_category FROM aqi_data
WHERE date IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'P')""")
def point_lookup(spark, sf_dir):
    wanted = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P").select(
        F.col("o_orderdate").cast("date").alias("date"))
    return join.on_dates(index(spark, sf_dir), wanted).select("date", "aqi", "aqi_category")


# --- resampling -----------------------------------------------------------------------------

@query("R1_hourly_to_daily_mean", """SELECT event_type, CAST(ts AS DATE) AS date, round(avg(value), 6) AS value
FROM events GROUP BY 1, 2""")
def hourly_to_daily_mean(spark, sf_dir):
    return r6(resample.daily_mean(table(spark, sf_dir, "events"), ["event_type"]))


@query("R2_hourly_to_daily_sum", """WITH raw AS (SELECT CAST(c_nationkey AS VARCHAR) || '|' || o_orderstatus AS series,
  CAST(o_orderdate AS DATE) AS date, o_totalprice / 997e0 AS value FROM orders JOIN customer ON o_custkey = c_custkey),
span AS (SELECT series, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
  FROM raw GROUP BY series)
SELECT series, date, round(coalesce(sum(value), 0), 4) AS value FROM span LEFT JOIN raw USING (series, date)
GROUP BY 1, 2""")
def hourly_to_daily_sum(spark, sf_dir):
    return r6(resample.daily_sum(order_days(spark, sf_dir), ["series"]), digits=4)


def _months(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_returnflag").alias("series"), F.date_trunc("month", "l_shipdate").alias("ts")).agg(
        (F.avg("l_quantity") / 0.997).alias("value")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


_MONTH_SQL = f"""
WITH m AS (SELECT l_returnflag AS series, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
  avg(l_quantity) / 0.997e0 AS value FROM lineitem GROUP BY 1, 2),
spine AS ({spine_sql('(SELECT date FROM m UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem)', 'date')}),
placed AS (SELECT s.series, spine.date, m.value, row_number() OVER (PARTITION BY s.series ORDER BY spine.date) AS p
  FROM (SELECT DISTINCT series FROM m) s CROSS JOIN spine LEFT JOIN m ON m.series = s.series AND m.date = spine.date)
"""


@query("R3_monthly_to_daily", _MONTH_SQL + line_sql("placed", "daily", None)
       + "SELECT series, date, round(value, 6) AS value FROM daily")
def monthly_to_daily(spark, sf_dir):
    # A month stands on its first day, which may be before the first row.
    first, last = span(spark, sf_dir, "lineitem", "l_shipdate")
    return r6(resample.monthly_to_daily(_months(spark, sf_dir), ["series"], first[:8] + "01", last))


@query("R4_daily_pass_through", """SELECT l_returnflag AS series, CAST(l_shipdate AS DATE) AS date,
  round(avg(l_quantity), 6) AS value FROM lineitem GROUP BY 1, 2""")
def daily_pass_through(spark, sf_dir):
    days = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_returnflag").alias("series"), F.col("l_shipdate").alias("ts")).agg(F.avg("l_quantity").alias("value"))
    return r6(resample.daily_value(days, ["series"]))


@query("J1_spine_join", CELLS_SQL + "SELECT series, date, round(value, 6) AS value FROM cells")
def spine_join(spark, sf_dir):
    return r6(cells(spark, sf_dir))


@query("J1_wide_daily_table", f"""WITH raw AS (SELECT l_linestatus AS series, CAST(l_shipdate AS DATE) AS date,
  l_returnflag AS f, l_quantity AS v FROM lineitem),
spine AS ({spine_sql('lineitem', 'l_shipdate')}),
grid AS (SELECT series, date FROM (SELECT DISTINCT l_linestatus AS series FROM lineitem) CROSS JOIN spine),
span AS (SELECT l_linestatus AS series, min(CAST(l_shipdate AS DATE)) AS a, max(CAST(l_shipdate AS DATE)) AS b
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT series, date, round(avg(v) FILTER (WHERE f = 'A'), 6) AS PM2_5, round(avg(v) FILTER (WHERE f = 'N'), 6) AS wind_u10m,
  CASE WHEN date BETWEEN any_value(a) AND any_value(b) THEN coalesce(sum(v) FILTER (WHERE f = 'R'), 0e0) END AS precipitation
FROM grid LEFT JOIN raw USING (series, date) LEFT JOIN span USING (series) GROUP BY series, date""")
def wide_daily_table(spark, sf_dir):
    names = {"A": "PM2_5", "N": "wind_u10m", "R": "precipitation"}
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("series"), F.col("l_shipdate").alias("ts"),
        clean.lookup(F.col("l_returnflag"), names).alias("feature"), F.col("l_quantity").alias("value"))
    wide = resample.to_daily_table(
        raw, ["series"], {f: "hourly" for f in names.values()}, *span(spark, sf_dir, "lineitem", "l_shipdate"))
    return r6(wide)


# --- the flagship: sensors by hour, completed, by day, banded ---------------------------------------

@query("E0_hourly_to_daily_bands", """
WITH h AS (SELECT event_type AS series, date_trunc('hour', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2),
spine AS (SELECT CAST(d AS TIMESTAMP) AS ts FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00',
  INTERVAL 1 HOUR) g(d)),
grid AS (SELECT s.series, spine.ts, h.value, row_number() OVER (PARTITION BY s.series ORDER BY spine.ts) AS p
  FROM (SELECT DISTINCT series FROM h) s CROSS JOIN spine LEFT JOIN h ON h.series = s.series AND h.ts = spine.ts)
""" + line_sql("grid", "filled", 30) + f""",
d AS (SELECT series, CAST(ts AS DATE) AS date, round(avg(value), 6) AS conc FROM filled GROUP BY 1, 2),
b AS (SELECT series, {CATEGORY_SQL.format(
        __import__('checks.bindings', fromlist=['sub_sql']).sub_sql('conc', catalog.BREAKPOINTS['PM2_5']))}
  AS aqi_category FROM d)
SELECT series, aqi_category, count(*) AS days, round(count(*) * 100e0 / sum(count(*)) OVER (PARTITION BY series), 6) AS pct
FROM b GROUP BY 1, 2""")
def hourly_to_daily_bands(spark, sf_dir):
    from hazegrid.functions.numeric import percent
    from hazegrid.operators import chunks
    from pyspark.sql import Window
    hourly = table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("series"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")
    ).agg(F.avg("value").alias("value"))
    placed = resample.on_spine(
        hourly, ["series"], "2024-01-01 00:00:00", "2024-01-30 23:00:00", step="1 hour", name="ts")
    completed = gapfill.fill_gaps(
        placed, ["series"], chunks.hour(F.col("ts")), {"value": gapfill.Fill(reach=30)})
    daily = r6(resample.daily_mean(completed, ["series"]))
    bands = daily.select("series", air_fn.sub_index("value", catalog.BREAKPOINTS["PM2_5"]).alias("aqi")).select(
        "series", air_fn.category(F.col("aqi")).alias("aqi_category"))
    counts = bands.groupBy("series", "aqi_category").agg(F.count(F.lit(1)).alias("days"))
    # At most seven rows per series by now.
    whole = F.sum("days").over(Window.partitionBy("series"))
    return counts.select("series", "aqi_category", "days", F.round(percent(F.col("days"), whole), 6).alias("pct"))
