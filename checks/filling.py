"""Gap filling and windows (G and W rows) on gappy daily series."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import query
from checks.bindings import CELLS_SQL, DENSE_SQL, INDEX_SQL, carry_sql, cells, day, dense, index, line_sql, r6
from hazegrid.functions import air as air_fn, weather
from hazegrid.operators import gapfill, stats, windows
from hazegrid.session import stage

KEYS = ["series"]
OUT = "SELECT series, date, round(value, 6) AS value FROM "


@query("G1_linear_fill", CELLS_SQL + line_sql("cells", "a", None) + OUT + "a")
def linear_fill(spark, sf_dir):
    return r6(gapfill.fill_gaps(cells(spark, sf_dir), KEYS, day(), {"value": gapfill.LINEAR}))


@query("G2_limited_linear_fill", CELLS_SQL + line_sql("cells", "a", 7) + OUT + "a")
def limited_linear_fill(spark, sf_dir):
    return r6(gapfill.fill_gaps(cells(spark, sf_dir), KEYS, day(), {"value": gapfill.Fill(reach=7)}))


@query("G3_forward_backward_fill", CELLS_SQL + carry_sql("cells", "a", 2) + OUT + "a")
def forward_backward_fill(spark, sf_dir):
    return r6(gapfill.fill_gaps(cells(spark, sf_dir), KEYS, day(), {"value": gapfill.forward_backward(2)}))


_LOW, _HIGH = 20.0, 450.0


@query("G4_pollutant_policy", CELLS_SQL + line_sql("cells", "a", 30) + carry_sql("a", "b", 2) + f""",
had AS (SELECT series, bool_or(value IS NULL) AS gaps FROM cells GROUP BY 1),
bad AS (SELECT series, bool_or(value < {_LOW} OR value > {_HIGH}) AS outside FROM b GROUP BY 1),
c AS (SELECT b.* REPLACE (CASE WHEN value < {_LOW} OR value > {_HIGH} THEN NULL ELSE value END AS value) FROM b)"""
       + line_sql("c", "d", 30) + carry_sql("d", "e", 2) + f"""
SELECT b.series, b.date, round(CASE WHEN gaps AND outside THEN
    CASE WHEN e.value < {_LOW} THEN {_LOW}::DOUBLE WHEN e.value > {_HIGH} THEN {_HIGH}::DOUBLE ELSE e.value END
  ELSE b.value END, 6) AS value
FROM b JOIN e ON b.series = e.series AND b.p = e.p JOIN had ON had.series = b.series JOIN bad ON bad.series = b.series""")
def pollutant_policy(spark, sf_dir):
    return r6(gapfill.fill_pollutants(
        cells(spark, sf_dir), KEYS, day(), {"value": (_LOW, _HIGH)}, stage=stage))


_DENSE_COLUMNS = ["PM2_5", "wind_u10m", "wind_v10m"]


@query("G5_dense_weather_policy", DENSE_SQL + f""", share AS (SELECT series,
  count(*) FILTER (WHERE PM2_5 IS NULL) * 100e0 / count(*) < 10 AS few FROM dense GROUP BY 1)"""
       + line_sql("dense", "a", None, "PM2_5") + """
SELECT a.series, a.date, round(CASE WHEN few THEN a.PM2_5 ELSE d.PM2_5 END, 6) AS PM2_5 FROM a
JOIN dense d ON d.series = a.series AND d.p = a.p JOIN share ON share.series = a.series""")
def dense_weather_policy(spark, sf_dir):
    df = dense(spark, sf_dir).select("series", "date", "PM2_5")
    return r6(gapfill.fill_by_share(df, KEYS, day(), ["PM2_5"], gapfill.LINEAR, below_pct=10.0))


@query("G6_sparse_weather_policy", CELLS_SQL + """, months AS (SELECT series, month(date) AS m, avg(value) AS base
  FROM cells GROUP BY 1, 2), share AS (SELECT series, (count(*) - count(value)) * 100e0 / count(*) < 10 AS few
  FROM cells GROUP BY 1)""" + line_sql("cells", "lim", 30) + line_sql("cells", "un", None) + """
SELECT lim.series, lim.date, round(CASE WHEN few THEN un.value ELSE coalesce(lim.value, base) END, 6) AS value
FROM lim JOIN un ON un.series = lim.series AND un.p = lim.p JOIN share ON share.series = lim.series
LEFT JOIN months ON months.series = lim.series AND months.m = month(lim.date)""")
def sparse_weather_policy(spark, sf_dir):
    return r6(gapfill.fill_weather(cells(spark, sf_dir), KEYS, "date", ["value"]))


@query("G7_recomputed_columns", DENSE_SQL + """, r AS (SELECT series, date, p,
  coalesce(PM10, PM2_5 * 1.6e0) AS PM10,
  coalesce(wind_speed, sqrt(wind_u10m * wind_u10m + wind_v10m * wind_v10m)) AS wind_speed FROM dense),
share AS (SELECT series, count(*) FILTER (WHERE PM10 IS NULL) < count(*) * 0.1 AS f1,
  count(*) FILTER (WHERE wind_speed IS NULL) < count(*) * 0.1 AS f2 FROM r GROUP BY 1)"""
       + line_sql("r", "a", None, "PM10") + line_sql("r", "b", None, "wind_speed") + """
SELECT r.series, r.date, round(CASE WHEN f1 THEN a.PM10 ELSE r.PM10 END, 6) AS PM10,
  round(CASE WHEN f2 THEN b.wind_speed ELSE r.wind_speed END, 6) AS wind_speed
FROM r JOIN a ON a.series = r.series AND a.p = r.p JOIN b ON b.series = r.series AND b.p = r.p
JOIN share ON share.series = r.series""")
def recomputed_columns(spark, sf_dir):
    df = dense(spark, sf_dir)
    again = df.withColumn("PM10", F.coalesce("PM10", air_fn.coarse_from_fine(F.col("PM2_5")))).withColumn(
        "wind_speed", F.coalesce("wind_speed", weather.wind_speed(F.col("wind_u10m"), F.col("wind_v10m"))))
    out = gapfill.fill_by_share(again, KEYS, day(), ["PM10", "wind_speed"], gapfill.LINEAR, below_pct=10.0)
    return r6(out.select("series", "date", "PM10", "wind_speed"))


def _sweep_sql(column: str) -> str:
    return line_sql("dense", f"l_{column}", 30, column) + carry_sql(f"l_{column}", f"s_{column}", 2, column)


@query("G8_final_sweep", DENSE_SQL + _sweep_sql("PM10") + _sweep_sql("wind_speed") + """,
share AS (SELECT series, count(*) FILTER (WHERE PM10 IS NULL) < count(*) * 0.5 AS f1,
  count(*) FILTER (WHERE wind_speed IS NULL) < count(*) * 0.5 AS f2 FROM dense GROUP BY 1)
SELECT d.series, d.date, round(CASE WHEN f1 THEN a.PM10 ELSE d.PM10 END, 6) AS PM10,
  round(CASE WHEN f2 THEN b.wind_speed ELSE d.wind_speed END, 6) AS wind_speed
FROM dense d JOIN s_PM10 a ON a.series = d.series AND a.p = d.p
JOIN s_wind_speed b ON b.series = d.series AND b.p = d.p JOIN share ON share.series = d.series""")
def final_sweep(spark, sf_dir):
    df = dense(spark, sf_dir).select("series", "date", "PM10", "wind_speed")
    return r6(gapfill.fill_by_share(df, KEYS, day(), ["PM10", "wind_speed"], gapfill.LIMITED, below_pct=50.0))


@query("G9_fill_accounting", CELLS_SQL + line_sql("cells", "a", 7) + """
SELECT c.series, 'value' AS "column", count(*) - count(c.value) AS missing_before,
  count(*) - count(a.value) AS missing_after, count(a.value) - count(c.value) AS filled
FROM cells c JOIN a ON a.series = c.series AND a.p = c.p GROUP BY c.series""")
def fill_accounting(spark, sf_dir):
    before = cells(spark, sf_dir)
    after = gapfill.fill_gaps(before, KEYS, day(), {"value": gapfill.Fill(reach=7)})
    return gapfill.fill_report(before, after, KEYS, ["value"])


# --- windows ----------------------------------------------------------------------------------

_W = "OVER (PARTITION BY series ORDER BY date)"


@query("W1_lags", CELLS_SQL + f"""SELECT series, date, round(lag(value, 1) {_W}, 6) AS value_lag1,
  round(lag(value, 7) {_W}, 6) AS value_lag7 FROM cells""")
def lags(spark, sf_dir):
    return r6(windows.with_lags(cells(spark, sf_dir), KEYS, day(), ["value"]).select(
        "series", "date", "value_lag1", "value_lag7"))


@query("W2_repaired_lags", CELLS_SQL + f""", l AS (SELECT series, date,
  coalesce(lag(value, 1) {_W}, lead(value, 1) {_W}) AS l1, coalesce(lag(value, 7) {_W}, lead(value, 7) {_W}) AS l7
  FROM (SELECT * REPLACE (round(value, 6) AS value) FROM cells))
SELECT series, date, last_value(l1 IGNORE NULLS) OVER (PARTITION BY series ORDER BY date ROWS BETWEEN 1 PRECEDING AND
  CURRENT ROW) AS value_lag1, last_value(l7 IGNORE NULLS) OVER (PARTITION BY series ORDER BY date ROWS BETWEEN
  2 PRECEDING AND CURRENT ROW) AS value_lag7 FROM l""")
def repaired_lags(spark, sf_dir):
    return r6(windows.with_lags(cells(spark, sf_dir), KEYS, day(), ["value"], repair=True).select(
        "series", "date", "value_lag1", "value_lag7"))


def _rolling_sql(stats_of: dict[str, str], digits: int = 6) -> str:
    return ", ".join(
        f"round({f}(value) OVER (PARTITION BY series ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), "
        f"{digits}) AS value_rolling{n}_{name}" for n in (7, 14) for name, f in stats_of.items())


def _rolling(spark, sf_dir, wanted, digits=6):
    out = windows.with_rolling(cells(spark, sf_dir), KEYS, day(), ["value"], stats=wanted)
    return r6(out.drop("value"), digits=digits)


@query("W3_rolling_mean", CELLS_SQL + f"SELECT series, date, {_rolling_sql({'mean': 'avg'})} FROM cells")
def rolling_mean(spark, sf_dir):
    return _rolling(spark, sf_dir, ("mean",))


@query("W4_rolling_std", CELLS_SQL + f"SELECT series, date, {_rolling_sql({'std': 'stddev_samp'}, 4)} FROM cells")
def rolling_std(spark, sf_dir):
    return _rolling(spark, sf_dir, ("std",), digits=4)


@query("W5_rolling_min_max", CELLS_SQL + f"SELECT series, date, {_rolling_sql({'min': 'min', 'max': 'max'})} FROM cells")
def rolling_min_max(spark, sf_dir):
    return _rolling(spark, sf_dir, ("min", "max"))


@query("W6_repaired_rolling", CELLS_SQL + """, roll AS (SELECT series, date, p, avg(value) OVER (PARTITION BY series
  ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m FROM cells)"""
       + line_sql("roll", "a", 7, "m") + carry_sql("a", "b", 2, "m")
       + "SELECT series, date, round(m, 6) AS value_rolling7_mean FROM b")
def repaired_rolling(spark, sf_dir):
    rolled = windows.with_rolling(cells(spark, sf_dir), KEYS, day(), ["value"], (7,), ("mean",))
    out = windows.repair_rolling(rolled, KEYS, day(), ["value"], (7,), ("mean",))
    return r6(out.drop("value"))


@query("W7_rolling_band", INDEX_SQL + """, r AS (SELECT date, aqi,
  avg(aqi) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m7,
  avg(aqi) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS m30,
  stddev_samp(aqi) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS s7 FROM aqi_spine)
SELECT date, round(aqi, 6) AS aqi, round(m7, 6) AS aqi_rolling7_mean, round(m30, 6) AS aqi_rolling30_mean, round(s7, 4) AS aqi_rolling7_std,
  round(m7 - s7, 4) AS band_low, round(m7 + s7, 4) AS band_high FROM r""".replace(
      ", r AS", """, days AS (SELECT CAST(d AS DATE) AS date FROM generate_series((SELECT min(date) FROM aqi_data),
  (SELECT max(date) FROM aqi_data), INTERVAL 1 DAY) g(d)),
  aqi_spine AS (SELECT days.date, aqi / 0.997e0 AS aqi FROM days LEFT JOIN aqi_data USING (date)), r AS""", 1))
def rolling_band(spark, sf_dir):
    spine = _index_spine(spark, sf_dir).withColumn("aqi", F.col("aqi") / 0.997)
    out = windows.rolling_band(spine, ["station"], day()).drop("station")
    return r6(r6(out, "aqi", "aqi_rolling7_mean", "aqi_rolling30_mean"),
              "aqi_rolling7_std", "band_low", "band_high", digits=4)


def _index_spine(spark, sf_dir):
    """The daily index of one station, on a spine from its first to its last day."""
    days = index(spark, sf_dir).select(F.lit("all").alias("station"), "date", "aqi")
    spans = days.groupBy("station").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return spans.select("station", F.explode(F.sequence("a", "b")).alias("date")).join(
        days, ["station", "date"], "left")


@query("W7_yesterday_and_today", CELLS_SQL + f""", l AS (SELECT series, date, value, lag(value) {_W} AS value_lag1 FROM cells)
SELECT series, date, round(value, 6) AS value, round(value_lag1, 6) AS value_lag1 FROM l WHERE value IS NOT NULL AND value_lag1 IS NOT NULL""")
def yesterday_and_today(spark, sf_dir):
    return r6(windows.with_lags(cells(spark, sf_dir), KEYS, day(), ["value"], (1,)).dropna(
        subset=["value", "value_lag1"]))


@query("W7_lag_line", INDEX_SQL + """, days AS (SELECT CAST(d AS DATE) AS date FROM generate_series(
  (SELECT min(date) FROM aqi_data), (SELECT max(date) FROM aqi_data), INTERVAL 1 DAY) g(d)),
l AS (SELECT aqi AS y, lag(aqi) OVER (ORDER BY date) AS x FROM days LEFT JOIN aqi_data USING (date))
SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 4) AS intercept, round(corr(x, y), 6) AS r,
  count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) AS n FROM l""")
def lag_line(spark, sf_dir):
    pairs = windows.with_lags(_index_spine(spark, sf_dir), ["station"], day(), ["aqi"], (1,))
    line = stats.fitted_line(pairs, "aqi_lag1", "aqi")
    return r6(r6(line, "slope", "r"), "intercept", digits=4)


@query("W8_leads", CELLS_SQL + "SELECT series, date, " + ", ".join(
    f"round(lead(value, {h}) {_W}, 6) AS value_h{h}" for h in (1, 7, 30, 365)) + " FROM cells")
def leads(spark, sf_dir):
    return r6(windows.with_leads(cells(spark, sf_dir), KEYS, day(), ["value"], (1, 7, 30, 365)).drop("value"))
