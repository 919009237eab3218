"""Derived columns (D rows): each over the whole observation table."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import query
from checks.bindings import (
    AIR_SQL, CATEGORY_SQL, INDEX_SQL, OBSERVATIONS_SQL, SEASON_SQL, _B, air, clip_sql, index, observations, r6,
    sub_sql, computed_air, table, with_weather,
)
from hazegrid import catalog
from hazegrid.functions import advice, air as air_fn, calendar, labels, weather
from hazegrid.functions.numeric import clip, lookup, percent
from hazegrid.operators import stats

KEY = ("l_orderkey", "l_linenumber", "date")
KEY_SQL = "l_orderkey, l_linenumber, date"


@query("D1_particle_units", OBSERVATIONS_SQL + f"""
SELECT {KEY_SQL}, PM2_5 * 1e9 AS pm25_ug, round(PM2_5 * 1e9 * 1.6e0 / 1e6, 6) AS pm10_mg FROM obs""")
def particle_units(spark, sf_dir):
    fine = air_fn.micrograms(F.col("PM2_5"))
    return observations(spark, sf_dir).select(
        *KEY, fine.alias("pm25_ug"), F.round(air_fn.coarse_from_fine(fine) / 1e6, 6).alias("pm10_mg"))


@query("D2_relative_humidity", AIR_SQL + f"SELECT {KEY_SQL}, round(humidity, 6) AS humidity FROM wx")
def relative_humidity(spark, sf_dir):
    return r6(with_weather(observations(spark, sf_dir)).select(*KEY, "humidity"))


@query("D3_wind_speed", """SELECT vec_id, label, i - 1 AS i,
  round(sqrt(CAST(embedding[i] AS DOUBLE) ** 2 + CAST(embedding[i + 1] AS DOUBLE) ** 2), 6) AS wind_speed
FROM (SELECT vec_id, label, embedding, CAST(unnest(range(1, len(embedding), 2)) AS INTEGER) AS i FROM embeddings)""")
def wind_speed(spark, sf_dir):
    return r6(_wind(spark, sf_dir).select(
        "vec_id", "label", "i", weather.wind_speed(F.col("u"), F.col("v")).alias("wind_speed")))


def _wind(spark, sf_dir):
    """Successive pairs of vector elements as wind components."""
    vectors = table(spark, sf_dir, "embeddings")
    starts = F.sequence(F.lit(0), F.size("embedding") - 2, F.lit(2))
    return vectors.select("vec_id", "label", "embedding", F.explode(starts).alias("i")).select(
        "vec_id", "label", "i", F.col("embedding")[F.col("i")].cast("double").alias("u"),
        F.col("embedding")[F.col("i") + 1].cast("double").alias("v"))


@query("D4_wind_direction", """SELECT vec_id, label, i - 1 AS i,
  round(fmod(degrees(atan2(CAST(embedding[i] AS DOUBLE), CAST(embedding[i + 1] AS DOUBLE))) + 360e0, 360e0), 6)
  AS wind_direction
FROM (SELECT vec_id, label, embedding, CAST(unnest(range(1, len(embedding), 2)) AS INTEGER) AS i FROM embeddings)""")
def wind_direction(spark, sf_dir):
    return r6(_wind(spark, sf_dir).select(
        "vec_id", "label", "i", weather.wind_direction(F.col("u"), F.col("v")).alias("wind_direction")))


@query("D5_calendar_fields", AIR_SQL + f"""
SELECT {KEY_SQL}, year, month, day, weekday, day_of_year, is_weekend FROM wx""")
def calendar_fields(spark, sf_dir):
    fields = calendar.calendar_fields(F.col("date"))
    fields.pop("season")
    return observations(spark, sf_dir).select(*KEY, *[c.alias(n) for n, c in fields.items()])


@query("D6_season_code", AIR_SQL + f"SELECT {KEY_SQL}, season FROM wx")
def season_code(spark, sf_dir):
    return observations(spark, sf_dir).select(*KEY, calendar.season_code(F.month("date")).alias("season"))


@query("D7_season_names", AIR_SQL + f"""
SELECT {KEY_SQL}, CASE l_linenumber WHEN 1 THEN 'Spring' WHEN 2 THEN 'Summer' WHEN 3 THEN 'Autumn' WHEN 4 THEN 'Fall'
    ELSE CAST(l_linenumber AS VARCHAR) END AS by_number,
  CASE season WHEN 0 THEN 'Winter' WHEN 1 THEN 'Spring' WHEN 2 THEN 'Summer' ELSE 'Autumn' END AS season_name,
  CAST(CASE WHEN l_linenumber IN (1, 2, 3) THEN l_linenumber WHEN l_linenumber = 4 THEN 3
    ELSE season END AS INTEGER) AS back
FROM wx""")
def season_names(spark, sf_dir):
    # Code 4 reads "Fall" and turns back into 3; codes above stay numbers and
    # turn back into the season of the month.
    name = calendar.season_name(F.col("l_linenumber"))
    return observations(spark, sf_dir).select(
        *KEY, name.alias("by_number"),
        calendar.season_name(calendar.season_code(F.month("date"))).alias("season_name"),
        calendar.season_from_name(name, F.month("date")).alias("back"))


@query("D8_decade", OBSERVATIONS_SQL + f"SELECT {KEY_SQL}, CAST(year(date) // 10 * 10 AS INTEGER) AS decade FROM obs")
def decade(spark, sf_dir):
    return observations(spark, sf_dir).select(*KEY, calendar.decade(F.year("date")).alias("decade"))


@query("D9_sub_index", f"SELECT event_id, {sub_sql('value', _B['PM2_5'])} AS sub_index FROM events")
def sub_index(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", air_fn.sub_index("value", catalog.BREAKPOINTS["PM2_5"]).alias("sub_index"))


@query("D10_concentrations", OBSERVATIONS_SQL + f"""
SELECT {KEY_SQL}, CO / 1000e0 AS co_ppm, {clip_sql('(NO2_trop * 2.67e-16)', '0e0', '5000e0')} AS no2_ppb,
  {clip_sql('((SO2_column - 1e0) * 100e0)', '0e0', '5000e0')} AS so2_ppb,
  {clip_sql('(O3 * 0.2e0)', '0e0', '1000e0')} AS o3_ppb FROM obs""")
def concentrations(spark, sf_dir):
    # SO2 is shifted below zero, to see that clipping turns negatives into 0.
    shifted = observations(spark, sf_dir).withColumn("SO2_column", F.col("SO2_column") - 1.0)
    names = {"CO": "co_ppm", "NO2_trop": "no2_ppb", "SO2_column": "so2_ppb", "O3": "o3_ppb"}
    return shifted.select(*KEY, *[air_fn.concentration(c).alias(name) for c, name in names.items()])


@query("D11_overall_index", AIR_SQL + f"SELECT {KEY_SQL}, aqi FROM air")
def overall_index(spark, sf_dir):
    return computed_air(spark, sf_dir).select(*KEY, "aqi")


@query("D12_category", f"SELECT event_id, {CATEGORY_SQL.format('nullif(value, 1.5e0)')} AS aqi_category FROM events")
def category(spark, sf_dir):
    value = F.nullif(F.col("value"), F.lit(1.5))
    return table(spark, sf_dir, "events").select("event_id", air_fn.category(value).alias("aqi_category"))


@query("D13_pollution_level", """SELECT event_id, CASE WHEN nullif(value, 1.5e0) IS NULL THEN 'Unknown'
  WHEN value <= 50 THEN 'Low' WHEN value <= 100 THEN 'Moderate' WHEN value <= 150 THEN 'High'
  ELSE 'Very High' END AS pollution_level FROM events""")
def pollution_level(spark, sf_dir):
    value = F.nullif(F.col("value"), F.lit(1.5))
    return table(spark, sf_dir, "events").select("event_id", air_fn.pollution_level(value).alias("pollution_level"))


@query("D14_report_band", """SELECT event_id, CASE WHEN v IS NULL THEN 'Very Unhealthy' WHEN v > 200 THEN 'Very Unhealthy'
  WHEN v > 150 THEN 'Unhealthy' WHEN v > 100 THEN 'Unhealthy for Sensitive' WHEN v > 50 THEN 'Moderate'
  ELSE 'Good' END AS band FROM (SELECT event_id, nullif(value, 1.5e0) AS v FROM events)""")
def report_band(spark, sf_dir):
    value = F.nullif(F.col("value"), F.lit(1.5))
    return table(spark, sf_dir, "events").select("event_id", air_fn.report_band(value).alias("band"))


@query("D15_status", AIR_SQL + f"""SELECT {KEY_SQL},
  CASE WHEN aqi <= 100 THEN 'Bình thường' ELSE 'Ô nhiễm' END AS status FROM air""")
def status(spark, sf_dir):
    return air(spark, sf_dir).select(*KEY, air_fn.status(F.col("aqi_category")).alias("status"))


@query("D16_dominant_component", AIR_SQL + f"""SELECT {KEY_SQL}, (SELECT arg_min(n, o) FROM (VALUES
    (i_pm25, 'PM2_5', 1), (i_pm10, 'PM10', 2), (i_no2, 'NO2_trop', 3), (i_so2, 'SO2_column', 4), (i_co, 'CO', 5),
    (i_o3, 'O3', 6)) t(i, n, o) WHERE t.i = aqi) AS component FROM air""")
def dominant_component(spark, sf_dir):
    return stats.dominant_components(observations(spark, sf_dir)).select(*KEY, "component")


@query("D17_correlation_labels", AIR_SQL + """, r AS (
  SELECT 'temperature_mean' AS variable, corr(temperature_mean, aqi) AS r FROM air
  UNION ALL SELECT 'humidity', corr(humidity, aqi) FROM air
  UNION ALL SELECT 'wind_speed', corr(wind_speed, aqi) FROM air)
SELECT variable, round(r, 6) AS r, CASE WHEN abs(r) < 0.1 THEN 'Không đáng kể' WHEN abs(r) < 0.3 THEN 'Yếu'
  WHEN abs(r) < 0.5 THEN 'Trung bình' WHEN abs(r) < 0.7 THEN 'Mạnh' ELSE 'Rất mạnh' END AS strength,
  CASE WHEN r > 0 THEN 'Tăng' ELSE 'Giảm' END AS direction FROM r""")
def correlation_labels(spark, sf_dir):
    return r6(stats.correlations(air(spark, sf_dir), ["temperature_mean", "humidity", "wind_speed"]))


@query("D18_to_celsius", """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date,
  round(CASE WHEN l_quantity * 6e0 > 50 THEN l_quantity * 6e0 - 273.15e0 ELSE l_quantity * 6e0 END, 6) AS celsius
FROM lineitem""")
def to_celsius(spark, sf_dir):
    reading = F.col("l_quantity") * 6.0
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("date"),
        F.round(weather.to_celsius(reading), 6).alias("celsius"))


@query("D19_trend_verdict", AIR_SQL + """, y AS (
  SELECT series, year, round_even(avg(aqi) * 100, 0) / 100 AS m FROM air GROUP BY 1, 2),
c AS (SELECT series, arg_max(m, year) - arg_min(m, year) AS change FROM y GROUP BY 1)
SELECT series, round(change, 6) AS change, CASE WHEN change < -5 THEN 'CẢI THIỆN' WHEN change > 5 THEN 'XẤU ĐI'
  ELSE 'ỔN ĐỊNH' END AS verdict FROM c""")
def trend_verdict(spark, sf_dir):
    yearly = stats.grouped_stats(air(spark, sf_dir), ["series", "year"], {"mean": F.avg("aqi")})
    change = yearly.groupBy("series").agg(
        (F.max_by("mean", "year") - F.min_by("mean", "year")).alias("change"))
    return r6(change.withColumn("verdict", labels.trend_verdict(F.col("change"))))


@query("D20_weather_flags", OBSERVATIONS_SQL + f"""SELECT {KEY_SQL}, month(date) IN (12, 1, 2) AS is_winter,
  month(date) = 10 OR (month(date) = 11 AND day(date) <= 15) AS is_flower_season,
  temperature_mean - 273.15e0 < 20 AS is_cold, temperature_mean - 273.15e0 > 30 AS is_hot FROM obs""")
def weather_flags(spark, sf_dir):
    flags = advice.weather_flags(F.col("date"), F.col("temperature_mean"))
    return observations(spark, sf_dir).select(*KEY, *[c.alias(n) for n, c in flags.items()])


_ACTIONS = " | "
_GOOD = _ACTIONS.join(catalog.ACTIONS_GOOD)
_MODERATE = _ACTIONS.join(catalog.ACTIONS_MODERATE)
_UNHEALTHY = _ACTIONS.join(catalog.ACTIONS_UNHEALTHY)


@query("D21_recommendations", AIR_SQL + f"""SELECT {KEY_SQL}, aqi_category AS category,
  CASE aqi_category {' '.join(f"WHEN '{c}' THEN '{t[0]}'" for c, t in catalog.ADVICE.items())} END AS title,
  CASE aqi_category {' '.join(f"WHEN '{c}' THEN '{t[1]}'" for c, t in catalog.ADVICE.items())} END AS health,
  concat_ws('{_ACTIONS}', CASE WHEN aqi <= 50 THEN '{_GOOD}' WHEN aqi <= 100 THEN '{_MODERATE}'
      WHEN aqi <= 150 THEN '{_UNHEALTHY}' ELSE '{catalog.ACTION_MASK}{_ACTIONS}{_UNHEALTHY}' END,
    CASE WHEN season = 0 OR temperature_mean - 273.15e0 < 20 THEN '{catalog.ACTION_COLD}' END,
    CASE WHEN temperature_mean - 273.15e0 > 30 THEN '{catalog.ACTION_HOT}' END,
    CASE WHEN month = 10 OR (month = 11 AND day <= 15) THEN '{catalog.ACTION_FLOWER[0]}'
      || strftime(date, '%d/%m') || '{catalog.ACTION_FLOWER[1]}' END) AS actions FROM air""")
def recommendations(spark, sf_dir):
    parts = advice.recommendation(
        F.col("aqi"), F.col("date"), F.col("temperature_mean"), F.col("aqi_category"))
    parts["actions"] = F.array_join(parts["actions"], _ACTIONS)
    return air(spark, sf_dir).select(*KEY, *[c.alias(n) for n, c in parts.items()])


@query("D22_bounded_prediction_error", INDEX_SQL + """, p AS (
  SELECT date, aqi AS actual, CASE WHEN PM2_5 IS NOT NULL THEN least(greatest(PM2_5 * 4e0 - 300e0, 0e0), 500e0) END
  AS predicted FROM aqi_data)
SELECT date, predicted, round(abs(predicted - actual), 6) AS error,
  round(abs(predicted - actual) * 100e0 / actual, 6) AS error_pct FROM p""")
def bounded_prediction_error(spark, sf_dir):
    df = index(spark, sf_dir).select(
        "date", clip(F.col("PM2_5") * 4.0 - 300.0, 0.0, 500.0).alias("predicted"), F.col("aqi").alias("actual"))
    error = F.abs(F.col("predicted") - F.col("actual"))
    return df.select("date", "predicted", F.round(error, 6).alias("error"),
                     F.round(percent(error, F.col("actual")), 6).alias("error_pct"))
