"""Aggregations, joins of facts, sorting and top-k (A, J2, J3, T rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import query
from checks.bindings import (
    AIR_SQL, HEALTH_SQL, INDEX_SQL, SINCE, air, health, index, r6, table,
)
from hazegrid import catalog
from hazegrid.functions import calendar
from hazegrid.functions.numeric import round_even
from hazegrid.operators import join, reports, stats


def e2(x: str) -> str:
    """Rounded to two digits, half to even."""
    return f"round_even(({x}) * 100, 0) / 100"


@query("A1_yearly_index", AIR_SQL + f"""SELECT year, {e2('avg(aqi)')} AS mean, {e2('min(aqi)')} AS min,
  {e2('max(aqi)')} AS max, {e2('stddev_samp(aqi)')} AS std FROM air GROUP BY year""")
def yearly_index(spark, sf_dir):
    return stats.yearly_index(air(spark, sf_dir))


@query("A1_first_to_last_year", AIR_SQL + f""", y AS (SELECT year, {e2('avg(aqi)')} AS m FROM air GROUP BY year),
e AS (SELECT min(year) AS first_year, max(year) AS last_year, arg_min(m, year) AS first_value,
  arg_max(m, year) AS last_value FROM y)
SELECT first_year, last_year, first_value, last_value, round(last_value - first_value, 6) AS change,
  round((last_value - first_value) * 100e0 / first_value, 6) AS change_pct,
  CASE WHEN last_value - first_value < -5 THEN 'CẢI THIỆN' WHEN last_value - first_value > 5 THEN 'XẤU ĐI'
    ELSE 'ỔN ĐỊNH' END AS verdict FROM e""")
def first_to_last_year(spark, sf_dir):
    return r6(stats.first_to_last(stats.yearly_index(air(spark, sf_dir))))


@query("A2_yearly_trends", AIR_SQL + f"""SELECT year, {e2('avg(aqi)')} AS aqi_avg, {e2('max(aqi)')} AS aqi_max,
  {e2('min(aqi)')} AS aqi_min, {e2('avg(PM2_5)')} AS pm2_5_avg, {e2('avg(PM10)')} AS pm10_avg,
  {e2('avg(temperature_mean)')} AS temperature_avg, {e2('avg(humidity)')} AS humidity_avg,
  {e2('avg(wind_speed)')} AS wind_speed_avg FROM air GROUP BY year""")
def yearly_trends(spark, sf_dir):
    return stats.yearly_trends(air(spark, sf_dir))


@query("A3_decade_mean", AIR_SQL + f"""SELECT CAST(year // 10 * 10 AS INTEGER) AS decade, {e2('avg(aqi)')} AS mean
FROM air GROUP BY 1""")
def decade_mean(spark, sf_dir):
    return stats.decade_index(air(spark, sf_dir))


@query("A4_season_stats", AIR_SQL + f"""SELECT season, {e2('avg(aqi)')} AS aqi_mean, {e2('stddev_samp(aqi)')} AS aqi_std,
  {e2('min(aqi)')} AS aqi_min, {e2('max(aqi)')} AS aqi_max, {e2('avg(PM2_5)')} AS PM2_5_mean,
  {e2('avg(temperature_mean)')} AS temperature_mean_mean, {e2('avg(humidity)')} AS humidity_mean,
  {e2('avg(wind_speed)')} AS wind_speed_mean,
  CASE season WHEN 0 THEN 'Winter' WHEN 1 THEN 'Spring' WHEN 2 THEN 'Summer' ELSE 'Autumn' END AS season_name
FROM air GROUP BY season""")
def season_stats(spark, sf_dir):
    return stats.season_stats(air(spark, sf_dir))


def _extremes_sql(key: str, by: str = "aqi") -> str:
    return f"""SELECT arg_max({key}, ROW(m, -{key})) AS worst_{key}, max(m) AS worst_value,
  arg_min({key}, ROW(m, {key})) AS best_{key}, min(m) AS best_value FROM g"""


@query("A4_extreme_seasons", AIR_SQL + f", g AS (SELECT season, {e2('avg(aqi)')} AS m FROM air GROUP BY 1) "
       + _extremes_sql("season"))
def extreme_seasons(spark, sf_dir):
    return stats.extremes(stats.season_stats(air(spark, sf_dir)), "season", "aqi_mean")


@query("A5_month_stats", AIR_SQL + f"""SELECT month, {e2('avg(aqi)')} AS aqi, {e2('avg(PM2_5)')} AS PM2_5
FROM air GROUP BY month""")
def month_stats(spark, sf_dir):
    return stats.month_stats(air(spark, sf_dir))


@query("A5_extreme_months", AIR_SQL + f", g AS (SELECT month, {e2('avg(aqi)')} AS m FROM air GROUP BY 1) "
       + _extremes_sql("month"))
def extreme_months(spark, sf_dir):
    return stats.extremes(stats.month_stats(air(spark, sf_dir)), "month", "aqi")


@query("A6_weekday_mean", AIR_SQL + f"SELECT weekday, {e2('avg(aqi)')} AS aqi FROM air GROUP BY weekday")
def weekday_mean(spark, sf_dir):
    return stats.weekday_stats(air(spark, sf_dir))


_INDEX_COLUMNS = {"PM2_5": "i_pm25", "PM10": "i_pm10", "NO2_trop": "i_no2", "SO2_column": "i_so2", "CO": "i_co",
                  "O3": "i_o3"}


@query("A7_mean_sub_indices", AIR_SQL + " UNION ALL ".join(
    f"""SELECT '{n}' AS component, round(avg({c}), 6) AS mean_index, round((SELECT avg(aqi) FROM air), 6) AS actual_aqi
    FROM air""" for n, c in _INDEX_COLUMNS.items()))
def mean_sub_indices(spark, sf_dir):
    return r6(stats.mean_indices(air(spark, sf_dir)))


@query("A8_dominant_counts", AIR_SQL + """, d AS (SELECT CASE WHEN i_pm25 = aqi THEN 'PM2_5' WHEN i_pm10 = aqi THEN 'PM10'
  WHEN i_no2 = aqi THEN 'NO2_trop' WHEN i_so2 = aqi THEN 'SO2_column' WHEN i_co = aqi THEN 'CO'
  WHEN i_o3 = aqi THEN 'O3' END AS component FROM air)
SELECT component, count(*) AS n, round(count(*) * 100e0 / (SELECT count(*) FROM d), 6) AS pct FROM d
WHERE component IS NOT NULL GROUP BY component ORDER BY n DESC, component LIMIT 5""")
def dominant_counts(spark, sf_dir):
    return r6(stats.dominant_counts(air(spark, sf_dir)))


_DRIVERS = ["PM2_5", "PM10", "NO2_trop", "SO2_column", "CO", "O3"]


def _corr_sql(columns) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS variable, corr({c}, aqi) AS r FROM air" for c in columns)


@query("A9_correlation_with_target", AIR_SQL + f""", r AS ({_corr_sql(_DRIVERS)})
SELECT variable, round(r, 6) AS r FROM r""")
def correlation_with_target(spark, sf_dir):
    return r6(stats.correlations(air(spark, sf_dir), _DRIVERS, labelled=False))


@query("A9_strongest_variable", AIR_SQL + f""", r AS ({_corr_sql(_DRIVERS)})
SELECT variable, round(r, 6) AS r FROM r ORDER BY abs(r) DESC, variable LIMIT 1""")
def strongest_variable(spark, sf_dir):
    return r6(stats.strongest(stats.correlations(air(spark, sf_dir), _DRIVERS, labelled=False)))


_NINE = list(catalog.POLLUTANTS)


def _pairs_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS first, '{b}' AS second, corr({a}, {b}) AS r FROM air"
        for i, a in enumerate(_NINE) for b in _NINE[i + 1:])


def _pairs(spark, sf_dir):
    return stats.correlation_pairs(air(spark, sf_dir), _NINE)


@query("A10_correlation_matrix", AIR_SQL + f""", p AS ({_pairs_sql()})
SELECT first, second, round(r, 6) AS r FROM p UNION ALL SELECT second, first, round(r, 6) FROM p
UNION ALL SELECT unnest({_NINE!r}), unnest({_NINE!r}), 1e0""")
def correlation_matrix(spark, sf_dir):
    return r6(stats.correlation_matrix(air(spark, sf_dir), _NINE))


@query("A11_strong_pairs", AIR_SQL + f""", p AS ({_pairs_sql()})
SELECT first, second, round(r, 6) AS r FROM p WHERE abs(r) > 0.5 ORDER BY abs(p.r) DESC, first, second LIMIT 10""")
def strong_pairs(spark, sf_dir):
    return r6(stats.strong_pairs(_pairs(spark, sf_dir)))


@query("A12_group_correlations", AIR_SQL + f""", p AS ({_pairs_sql()})
SELECT 'pm' AS "group", round(avg(r), 6) AS mean_r FROM p WHERE first IN {catalog.PM_GROUP!r} AND second IN {catalog.PM_GROUP!r}
UNION ALL SELECT 'gas', round(avg(r), 6) FROM p WHERE first IN {catalog.GAS_GROUP!r} AND second IN {catalog.GAS_GROUP!r}""")
def group_correlations(spark, sf_dir):
    return r6(stats.group_correlations(
        _pairs(spark, sf_dir), {"pm": catalog.PM_GROUP, "gas": catalog.GAS_GROUP}))


@query("A12_ozone_correlations", AIR_SQL + f""", p AS ({_pairs_sql()})
SELECT CASE WHEN first = 'O3' THEN second ELSE first END AS variable, round(r, 6) AS r FROM p
WHERE first = 'O3' OR second = 'O3'""")
def ozone_correlations(spark, sf_dir):
    return r6(stats.correlations_of(_pairs(spark, sf_dir), "O3"))


def _bins_sql(v: str) -> str:
    return f"""q_{v} AS (SELECT list_sort(list_distinct(quantile_cont({v}, [0, 0.2, 0.4, 0.6, 0.8, 1]))) AS e FROM air),
b_{v} AS (SELECT len(list_filter(e[2:len(e) - 1], lambda x: x < {v})) + 1 AS bin, aqi, PM2_5 FROM air, q_{v}
  WHERE {v} IS NOT NULL),
f_{v} AS (SELECT unnest(range(1, len(e))) AS bin, e FROM q_{v}),
o_{v} AS (SELECT '{v}' AS variable, CAST(f.bin AS INTEGER) AS bin, round(any_value(e[f.bin]), 6) AS low,
  round(any_value(e[f.bin + 1]), 6) AS high, count(b.bin) AS n, {e2('avg(aqi)')} AS aqi_mean,
  {e2('avg(PM2_5)')} AS PM2_5_mean FROM f_{v} f LEFT JOIN b_{v} b USING (bin) GROUP BY f.bin)"""


@query("A13_quantile_bins", AIR_SQL + ", " + ", ".join(
    _bins_sql(v) for v in ("temperature_mean", "humidity", "wind_speed")) + """
SELECT * FROM o_temperature_mean UNION ALL SELECT * FROM o_humidity UNION ALL SELECT * FROM o_wind_speed""")
def quantile_bins(spark, sf_dir):
    variables = ["temperature_mean", "humidity", "wind_speed"]
    df = air(spark, sf_dir).select(*variables, "aqi", "PM2_5")
    return r6(stats.quantile_bins(df, variables, {
        "aqi_mean": round_even(F.avg("aqi")), "PM2_5_mean": round_even(F.avg("PM2_5"))}), "low", "high")


@query("A14_category_counts", AIR_SQL + """SELECT aqi_category, count(*) AS n,
  round(count(*) * 100e0 / (SELECT count(*) FROM air), 6) AS pct FROM air GROUP BY aqi_category""")
def category_counts(spark, sf_dir):
    return r6(stats.category_counts(air(spark, sf_dir)))


@query("A14_top_categories", AIR_SQL + """SELECT aqi_category, count(*) AS n,
  round(count(*) * 100e0 / (SELECT count(*) FROM air), 6) AS pct FROM air GROUP BY aqi_category
ORDER BY n DESC, aqi_category LIMIT 3""")
def top_categories(spark, sf_dir):
    return r6(stats.category_counts(air(spark, sf_dir)).orderBy(F.desc("n"), "aqi_category").limit(3))


@query("A15_box_plot", AIR_SQL + """, q AS (SELECT aqi_category, quantile_cont(aqi, 0.25) AS q1,
  quantile_cont(aqi, 0.5) AS median, quantile_cont(aqi, 0.75) AS q3 FROM air GROUP BY 1),
j AS (SELECT aqi, q.*, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM air JOIN q USING (aqi_category))
SELECT aqi_category, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  min(aqi) FILTER (WHERE aqi >= lo) AS whisker_low, max(aqi) FILTER (WHERE aqi <= hi) AS whisker_high,
  count(*) AS n, count(*) FILTER (WHERE aqi < lo OR aqi > hi) AS outliers FROM j GROUP BY aqi_category, q1, median, q3""")
def box_plot(spark, sf_dir):
    return r6(stats.box_plot(air(spark, sf_dir)))


def _means_sql(by: str) -> str:
    return f"""SELECT {by}, round(avg(PM2_5), 6) AS PM2_5, round(avg(PM10), 6) AS PM10,
  round(avg(NO2_trop) * 1e-15, 6) AS NO2_trop, round(avg(SO2_column), 6) AS SO2_column, round(avg(CO), 6) AS CO,
  round(avg(O3), 6) AS O3 FROM air GROUP BY {by}"""


@query("A16_yearly_components", AIR_SQL + _means_sql("year"))
def yearly_components(spark, sf_dir):
    return r6(stats.component_means(air(spark, sf_dir), "year"))


@query("A16_component_change", AIR_SQL + f""", y AS ({_means_sql('year')}),
t AS (UNPIVOT y ON PM2_5, PM10, NO2_trop, SO2_column, CO, O3 INTO NAME component VALUE m),
e AS (SELECT component, arg_min(m, year) AS a, arg_max(m, year) AS b FROM t GROUP BY component)
SELECT component, a AS first_mean, b AS last_mean, round(b - a, 4) AS change,
  round(CASE WHEN a > 0 THEN (b - a) * 100e0 / a ELSE 0e0 END, 4) AS change_pct FROM e""")
def component_change(spark, sf_dir):
    yearly = r6(stats.component_means(air(spark, sf_dir), "year"))
    return r6(stats.component_change(yearly), "change", "change_pct", digits=4)


@query("A17_monthly_components", AIR_SQL + _means_sql("month"))
def monthly_components(spark, sf_dir):
    return r6(stats.component_means(air(spark, sf_dir), "month"))


@query("A17_peak_months", AIR_SQL + f""", y AS ({_means_sql('month')}),
t AS (UNPIVOT y ON PM2_5, PM10, NO2_trop, SO2_column, CO, O3 INTO NAME component VALUE m)
SELECT component, arg_max(month, ROW(m, -month)) AS worst_month, max(m) AS worst_value,
  arg_min(month, ROW(m, month)) AS best_month, min(m) AS best_value FROM t GROUP BY component""")
def peak_months(spark, sf_dir):
    return stats.peak_months(r6(stats.component_means(air(spark, sf_dir), "month")))


@query("A18_calendar_heatmap", AIR_SQL + "SELECT year, " + ", ".join(
    f'round(avg(aqi) FILTER (WHERE month = {m}), 6) AS "{m}"' for m in range(1, 13)) + " FROM air GROUP BY year")
def calendar_heatmap(spark, sf_dir):
    return r6(stats.calendar_heatmap(air(spark, sf_dir)))


@query("A18_extreme_year_months", AIR_SQL + """, g AS (SELECT year * 100 + month AS year_month, avg(aqi) AS m
  FROM air GROUP BY 1) SELECT arg_max(year_month, ROW(m, -year_month)) AS worst_year_month, round(max(m), 6) AS worst_value,
  arg_min(year_month, ROW(m, year_month)) AS best_year_month, round(min(m), 6) AS best_value FROM g""")
def extreme_year_months(spark, sf_dir):
    return r6(stats.extreme_months(air(spark, sf_dir)))


@query("A19_normal_and_polluted", AIR_SQL + """SELECT CASE WHEN aqi <= 100 THEN 'Bình thường' ELSE 'Ô nhiễm' END AS status,
  count(*) AS n, round(count(*) * 100e0 / (SELECT count(*) FROM air), 6) AS pct FROM air GROUP BY 1""")
def normal_and_polluted(spark, sf_dir):
    return r6(stats.status_counts(air(spark, sf_dir)))


def _line_sql(x: str, y: str) -> str:
    return (f"round(regr_slope({y}, {x}), 6) AS slope, round(regr_intercept({y}, {x}), 5) AS intercept, "
            f"round(corr({x}, {y}), 6) AS r, count(*) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL) AS n")


@query("A20_weather_line", AIR_SQL + "SELECT " + _line_sql("temperature_mean", "aqi") + " FROM air")
def weather_line(spark, sf_dir):
    line = stats.fitted_line(air(spark, sf_dir), "temperature_mean", "aqi")
    return r6(r6(line, "slope", "r"), "intercept", digits=5)


@query("A20_pollutant_line", AIR_SQL + "SELECT " + _line_sql("SO2_column", "PM2_5") + " FROM air")
def pollutant_line(spark, sf_dir):
    line = stats.fitted_line(air(spark, sf_dir), "SO2_column", "PM2_5")
    return r6(r6(line, "slope", "r"), "intercept", digits=5)


@query("A21_scatter_frame", AIR_SQL + """SELECT l_orderkey, l_linenumber, PM2_5, PM10, aqi FROM air
WHERE PM2_5 IS NOT NULL AND PM10 IS NOT NULL""")
def scatter_frame(spark, sf_dir):
    return air(spark, sf_dir).dropna(subset=["PM2_5", "PM10"]).select(
        "l_orderkey", "l_linenumber", "PM2_5", "PM10", "aqi")


@query("A21_scatter_facts", AIR_SQL + "SELECT round(corr(PM2_5, PM10), 6) AS r, round(max(PM2_5), 6) AS max_pm25 FROM air")
def scatter_facts(spark, sf_dir):
    return r6(stats.scatter_facts(air(spark, sf_dir), "PM2_5", "PM10").withColumnRenamed("max_x", "max_pm25"))


@query("A22_summary", AIR_SQL + """SELECT count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date,
  CAST(year(max(date)) - year(min(date)) AS INTEGER) AS years, min(aqi) AS min_index, max(aqi) AS max_index,
  round(avg(aqi), 6) AS mean_index FROM air""")
def summary(spark, sf_dir):
    return r6(stats.summary(air(spark, sf_dir)))


_PROFILED = ["PM2_5", "PM10", "SO2_column", "O3", "CO", "temperature_mean", "humidity", "wind_speed"]


@query("A22_column_profile", AIR_SQL + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, count(*) FILTER (WHERE {c} IS NULL) AS missing,
    round(count(*) FILTER (WHERE {c} IS NULL) * 100e0 / count(*), 6) AS missing_pct FROM air""" for c in _PROFILED))
def column_profile(spark, sf_dir):
    return r6(stats.column_profile(air(spark, sf_dir), _PROFILED))


@query("A23_totals", HEALTH_SQL + f"""SELECT (SELECT count(*) FROM aqi_data) AS total_aqi_records,
  (SELECT count(*) FROM health_data) AS total_health_records, (SELECT {e2('avg(aqi)')} FROM aqi_data) AS avg_aqi,
  (SELECT {e2('avg(health_index)')} FROM health_data) AS avg_health_index""")
def totals(spark, sf_dir):
    return reports.totals(index(spark, sf_dir), health(spark, sf_dir))


@query("A24_recent_years", INDEX_SQL + f"""SELECT year, round(avg(aqi), 6) AS avg_aqi, max(aqi) AS max_aqi,
  min(aqi) AS min_aqi FROM aqi_data WHERE year >= {SINCE} GROUP BY year""")
def recent_years(spark, sf_dir):
    return r6(reports.recent_years(index(spark, sf_dir), SINCE))


_JOINED = " FROM aqi_data a JOIN health_data h ON a.date = h.date "


@query("A25_recent_trends", HEALTH_SQL + f"""SELECT a.year, round(avg(a.aqi), 6) AS avg_aqi,
  round(avg(h.health_index), 4) AS avg_health {_JOINED} WHERE a.year >= {SINCE} GROUP BY a.year""")
def recent_trends(spark, sf_dir):
    df = reports.recent_trends(index(spark, sf_dir), health(spark, sf_dir), SINCE)
    return r6(r6(df, "avg_aqi"), "avg_health", digits=4)


@query("A26_seasonal_analysis", HEALTH_SQL + f"""SELECT a.season, round(avg(a.aqi), 6) AS avg_aqi,
  round(avg(h.respiratory_cases), 6) AS avg_respiratory, round(avg(h.cardiovascular_cases), 6) AS avg_cardio,
  round(avg(h.health_index), 4) AS avg_health {_JOINED} GROUP BY a.season""")
def seasonal_analysis(spark, sf_dir):
    df = reports.seasonal_analysis(index(spark, sf_dir), health(spark, sf_dir))
    return r6(r6(df, "avg_aqi", "avg_respiratory", "avg_cardio"), "avg_health", digits=4)


@query("A27_pollution_levels", HEALTH_SQL + f"""SELECT a.aqi_category, count(*) AS days, round(avg(a.aqi), 6) AS avg_aqi,
  round(avg(h.total_cases), 6) AS avg_cases {_JOINED} GROUP BY a.aqi_category""")
def pollution_levels(spark, sf_dir):
    return r6(reports.pollution_levels(index(spark, sf_dir), health(spark, sf_dir)))


@query("A28_health_impact", HEALTH_SQL + f"""SELECT CASE WHEN a.aqi > 200 THEN 'Very Unhealthy' WHEN a.aqi > 150
  THEN 'Unhealthy' WHEN a.aqi > 100 THEN 'Unhealthy for Sensitive' WHEN a.aqi > 50 THEN 'Moderate' ELSE 'Good' END
  AS pollution_level, count(*) AS days, round(avg(a.aqi), 6) AS avg_aqi,
  round(avg(h.respiratory_cases), 6) AS respiratory, round(avg(h.cardiovascular_cases), 6) AS cardiovascular,
  round(avg(h.total_cases), 6) AS total, round(avg(h.health_index), 4) AS health_index {_JOINED} GROUP BY 1""")
def health_impact(spark, sf_dir):
    df = reports.health_impact(index(spark, sf_dir), health(spark, sf_dir))
    names = ("avg_aqi", "respiratory", "cardiovascular", "total")
    return r6(r6(df, *names), "health_index", digits=4)


@query("J2_daily_facts_join", """WITH a AS (SELECT CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS quantity,
  count(*) AS lines FROM lineitem GROUP BY 1), b AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS orders,
  round(sum(o_totalprice), 2) AS price FROM orders GROUP BY 1)
SELECT date, quantity, lines, orders, price FROM a JOIN b USING (date)""")
def daily_facts_join(spark, sf_dir):
    shipped = join.to_day(table(spark, sf_dir, "lineitem"), "l_shipdate", {
        "quantity": F.sum("l_quantity"), "lines": F.count(F.lit(1))})
    ordered = join.to_day(table(spark, sf_dir, "orders"), "o_orderdate", {
        "orders": F.count(F.lit(1)), "price": F.round(F.sum("o_totalprice"), 2)})
    return join.by_day(shipped, ordered)


@query("J3_month_baseline", AIR_SQL + """SELECT l_orderkey, l_linenumber, date, PM2_5, round(avg(PM2_5) OVER (
  PARTITION BY series, month), 6) AS PM2_5_month_mean, CASE season WHEN 0 THEN 'Winter' WHEN 1 THEN 'Spring'
  WHEN 2 THEN 'Summer' ELSE 'Autumn' END AS season_name FROM air""")
def month_baseline(spark, sf_dir):
    df = join.month_baseline(air(spark, sf_dir), ["series"], "PM2_5")
    return df.select("l_orderkey", "l_linenumber", "date", "PM2_5",
                     F.round("PM2_5_month_mean", 6).alias("PM2_5_month_mean"),
                     calendar.season_name(F.col("season")).alias("season_name"))


@query("T1_top_days", INDEX_SQL + "SELECT date, aqi FROM aqi_data ORDER BY aqi DESC, date LIMIT 10")
def top_days(spark, sf_dir):
    return index(spark, sf_dir).select("date", "aqi").orderBy(F.desc("aqi"), "date").limit(10)


@query("T2_sort_by_size", AIR_SQL + f""", r AS ({_corr_sql(_DRIVERS)})
SELECT variable, round(r, 6) AS r, row_number() OVER (ORDER BY abs(r) DESC, variable) AS place FROM r""")
def sort_by_size(spark, sf_dir):
    corr = stats.correlations(air(spark, sf_dir), _DRIVERS, labelled=False)
    # Six rows by now: their order as a column.
    in_order = corr.agg(F.array_sort(F.collect_list(F.struct(
        (-F.abs("r")).alias("size"), "variable", "r"))).alias("all"))
    return r6(in_order.select(F.posexplode("all").alias("place", "x")).select(
        "x.variable", "x.r", (F.col("place") + 1).cast("long").alias("place")))


@query("T3_group_extremes", AIR_SQL + """, g AS (SELECT series, month, round(avg(aqi), 6) AS m FROM air GROUP BY 1, 2)
SELECT series, arg_max(month, ROW(m, -month)) AS worst_month, max(m) AS worst_value,
  arg_min(month, ROW(m, month)) AS best_month, min(m) AS best_value FROM g GROUP BY series""")
def group_extremes(spark, sf_dir):
    means = air(spark, sf_dir).groupBy("series", "month").agg(F.round(F.avg("aqi"), 6).alias("m"))
    return stats.extremes(means, "month", "m", by=("series",))


@query("T4_preview", "SELECT event_id, ts, event_type, value FROM events ORDER BY ts, event_id LIMIT 10")
def preview(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value").orderBy(
        "ts", "event_id").limit(10)


@query("T5_repeatable_sample", """SELECT o_orderkey, o_totalprice FROM orders
ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 1000""")
def repeatable_sample(spark, sf_dir):
    return stats.sample(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")


@query("T6_sorted_by_date", """SELECT date, aqi, row_number() OVER (ORDER BY date) - 1 AS row_no,
  count(*) OVER () AS n_rows FROM aqi_data""".replace("SELECT", INDEX_SQL + "SELECT", 1))
def sorted_by_date(spark, sf_dir):
    from hazegrid.operators import chunks
    days = index(spark, sf_dir).select(F.lit(0).alias("all"), "date", "aqi")
    return chunks.numbered(days, ["all"], chunks.day(F.col("date"))).drop("all")
