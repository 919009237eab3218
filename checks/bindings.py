"""The given tables in the roles of the daily air-quality model.

`air`     every lineitem row as one observation of all pollutants and weather
`health`  orders by day as health facts, `index` lineitem by day as daily index
`cells`   orders by customer nation and status on a daily spine (gappy)
`dense`   lineitem by line status on a daily spine (few gaps)
Spark frames and SQL texts are written independently of each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazegrid import catalog
from hazegrid.functions import air as air_fn, weather
from hazegrid.functions.calendar import calendar_fields
from hazegrid.operators import chunks, resample
from hazegrid.operators.index import with_index
from hazegrid.session import stage

SINCE = 1999
_spans: dict = {}


def span(spark: SparkSession, sf_dir: str, name: str, column: str) -> tuple[str, str]:
    """First and last day of a table."""
    key = (spark.sparkContext.applicationId, sf_dir, name, column)
    if key not in _spans:
        days = F.col(column).cast("date")
        _spans[key] = tuple(str(d) for d in table(spark, sf_dir, name).agg(F.min(days), F.max(days)).first())
    return _spans[key]


def spine_sql(name: str, column: str) -> str:
    """CTE body of all days from the first to the last one of a table."""
    return (f"SELECT CAST(unnest(generate_series(min(CAST({column} AS DATE)), max(CAST({column} AS DATE)), INTERVAL 1 DAY)) "
            f"AS DATE) AS date FROM {name}")


def day():
    return chunks.day(F.col("date"))



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round doubles for comparison; sums are taken in another order elsewhere."""
    names = columns or [c for c, t in df.dtypes if t == "double"]
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


# --- air: one observation per lineitem row ---------------------------------------------

def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    q, price, disc, tax, no = (
        F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"))
    shipped_f, open_o = F.col("l_linestatus") == "F", F.col("l_linestatus") == "O"
    return li.select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("series"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.when(~(shipped_f & (no == 4)), q * q * 0.2).alias("PM2_5"),
        (price / 400.0).alias("PM10"),
        (price * 1e13 + tax * 1e18).alias("NO2_trop"),
        (price * 1e13 + q * 1e15).alias("NO2_total"),
        F.when(~(open_o & (no == 2)), disc * 20.0).alias("SO2_column"),
        (disc * 1e-3 + tax * 1e-3).alias("SO2_surface"),
        (no * 60.0 + disc * 400.0).alias("O3"),
        (tax * 150000.0).alias("CO"),
        (q / 50.0 + tax).alias("AOD_550"),
        (270.0 + q * 0.8).alias("temperature_mean"),
        (262.0 + q * 0.75 + tax * 50.0).alias("dew_point"),
        (disc * 100.0 - 5.0).alias("wind_u10m"),
        (tax * 100.0 - 4.0).alias("wind_v10m"),
    )


def with_weather(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        weather.relative_humidity(F.col("temperature_mean"), F.col("dew_point")).alias("humidity"),
        weather.wind_speed(F.col("wind_u10m"), F.col("wind_v10m")).alias("wind_speed"),
        *[c.alias(n) for n, c in calendar_fields(F.col("date")).items()])


def computed_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_index(with_weather(observations(spark, sf_dir)))


_written: dict = {}


def air(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed table: written once per session, then read by all analyses."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        _written[key] = stage(computed_air(spark, sf_dir), "air")
    return _written[key]


def sub_sql(conc: str, breaks) -> str:
    levels = (0, 50, 100, 150, 200, 300, 400, 500)
    parts = [f"WHEN {conc} IS NULL OR {conc} < 0 THEN NULL"]
    for i in range(7):
        lo, hi = f"{breaks[i]!r}e0", f"{breaks[i + 1]!r}e0"
        a, b = f"{levels[i]}e0", f"{levels[i + 1]}e0"
        parts.append(
            f"WHEN {conc} >= {lo} AND {conc} <= {hi} THEN "
            f"round_even(({b} - {a}) / ({hi} - {lo}) * ({conc} - {lo}) + {a}, 0)")
    return "CASE " + " ".join(parts) + " ELSE 500e0 END"


def clip_sql(x: str, lo: str, hi: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} < {lo} THEN {lo} WHEN {x} > {hi} THEN {hi} ELSE {x} END"


CATEGORY_SQL = (
    "CASE WHEN {0} IS NULL THEN 'Unknown' WHEN {0} <= 50 THEN 'Good' WHEN {0} <= 100 THEN 'Moderate' "
    "WHEN {0} <= 150 THEN 'Unhealthy for Sensitive' WHEN {0} <= 200 THEN 'Unhealthy' "
    "WHEN {0} <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END")
SEASON_SQL = "CASE WHEN {0} IN (12,1,2) THEN 0 WHEN {0} <= 5 THEN 1 WHEN {0} <= 8 THEN 2 ELSE 3 END"

_B = catalog.BREAKPOINTS
OBSERVATIONS_SQL = """
WITH obs AS (SELECT l_orderkey, l_linenumber, l_returnflag AS series, CAST(l_shipdate AS DATE) AS date,
  CASE WHEN l_linestatus = 'F' AND l_linenumber = 4 THEN NULL ELSE l_quantity * l_quantity * 0.2e0 END AS PM2_5,
  l_extendedprice / 400e0 AS PM10,
  l_extendedprice * 1e13 + l_tax * 1e18 AS NO2_trop,
  l_extendedprice * 1e13 + l_quantity * 1e15 AS NO2_total,
  CASE WHEN l_linestatus = 'O' AND l_linenumber = 2 THEN NULL ELSE l_discount * 20e0 END AS SO2_column,
  l_discount * 1e-3 + l_tax * 1e-3 AS SO2_surface,
  l_linenumber * 60e0 + l_discount * 400e0 AS O3,
  l_tax * 150000e0 AS CO,
  l_quantity / 50e0 + l_tax AS AOD_550,
  270e0 + l_quantity * 0.8e0 AS temperature_mean,
  262e0 + l_quantity * 0.75e0 + l_tax * 50e0 AS dew_point,
  l_discount * 100e0 - 5e0 AS wind_u10m,
  l_tax * 100e0 - 4e0 AS wind_v10m
  FROM lineitem)
"""
AIR_SQL = OBSERVATIONS_SQL + f""", wx AS (SELECT *,
  least(greatest(100e0 * exp(17.27e0 * (dew_point - 273.15e0) / ((dew_point - 273.15e0) + 237.3e0))
    / exp(17.27e0 * (temperature_mean - 273.15e0) / ((temperature_mean - 273.15e0) + 237.3e0)), 0e0), 100e0) AS humidity,
  sqrt(wind_u10m * wind_u10m + wind_v10m * wind_v10m) AS wind_speed,
  CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
  CAST(isodow(date) - 1 AS INTEGER) AS weekday, CAST(dayofyear(date) AS INTEGER) AS day_of_year,
  CAST(CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
  CAST({SEASON_SQL.format('month(date)')} AS INTEGER) AS season FROM obs),
idx AS (SELECT *, {sub_sql('PM2_5', _B['PM2_5'])} AS i_pm25, {sub_sql('PM10', _B['PM10'])} AS i_pm10,
  {sub_sql('(' + clip_sql('(NO2_trop * 2.67e-16)', '0e0', '5000e0') + ')', _B['NO2_trop'])} AS i_no2,
  {sub_sql('(' + clip_sql('(SO2_column * 100e0)', '0e0', '5000e0') + ')', _B['SO2_column'])} AS i_so2,
  {sub_sql('(CO / 1000e0)', _B['CO'])} AS i_co,
  {sub_sql('(' + clip_sql('(O3 * 0.2e0)', '0e0', '1000e0') + ')', _B['O3'])} AS i_o3 FROM wx),
air AS (SELECT *, greatest(i_pm25, i_pm10, i_no2, i_so2, i_co, i_o3) AS aqi,
  {CATEGORY_SQL.format('greatest(i_pm25, i_pm10, i_no2, i_so2, i_co, i_o3)')} AS aqi_category FROM idx)
"""


# --- daily index and health facts -----------------------------------------------------------

def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day: mean index and PM2.5 of all observations."""
    daily = air(spark, sf_dir).groupBy("date").agg(
        F.round(F.avg("aqi"), 6).alias("aqi"), F.round(F.avg("PM2_5"), 6).alias("PM2_5"))
    return daily.select(
        "*", *[c.alias(n) for n, c in calendar_fields(F.col("date")).items() if n in ("year", "month", "season")]
    ).withColumn("aqi_category", air_fn.category(F.col("aqi")))


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.avg("o_totalprice").alias("health_index"),
        F.count(F.lit(1)).cast("double").alias("respiratory_cases"),
        F.count_if(F.col("o_orderstatus") == "F").cast("double").alias("cardiovascular_cases"),
        F.count(F.lit(1)).cast("double").alias("_n")).select(
        "date", "health_index", "respiratory_cases", "cardiovascular_cases",
        (F.col("_n") + F.col("cardiovascular_cases")).alias("total_cases"))


INDEX_SQL = AIR_SQL + f""", aqi_data AS (SELECT *, CAST(year(date) AS INTEGER) AS year,
  CAST(month(date) AS INTEGER) AS month, CAST({SEASON_SQL.format('month(date)')} AS INTEGER) AS season,
  {CATEGORY_SQL.format('aqi')} AS aqi_category
  FROM (SELECT date, round(avg(aqi), 6) AS aqi, round(avg(PM2_5), 6) AS PM2_5 FROM air GROUP BY date))
"""
HEALTH_SQL = INDEX_SQL + """, health_data AS (SELECT CAST(o_orderdate AS DATE) AS date,
  avg(o_totalprice) AS health_index, CAST(count(*) AS DOUBLE) AS respiratory_cases,
  CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS cardiovascular_cases,
  CAST(count(*) + count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS total_cases FROM orders GROUP BY 1)
"""


# --- gappy daily series --------------------------------------------------------------------------

def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series, ts, value): orders by customer nation and status.

    The odd divisor keeps interpolated values off decimal ties, on which the
    rounding of two engines may part.
    """
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.concat_ws("|", F.col("c_nationkey").cast("string"), "o_orderstatus").alias("series"),
        F.col("o_orderdate").alias("ts"), (F.col("o_totalprice") / 997.0).alias("value"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series, date, value) on the daily spine; about one cell in twelve is present at sf0.01."""
    days = resample.daily_mean(order_days(spark, sf_dir), ["series"])
    return resample.on_spine(days, ["series"], *span(spark, sf_dir, "orders", "o_orderdate"))


CELLS_SQL = f"""
WITH raw AS (SELECT CAST(c_nationkey AS VARCHAR) || '|' || o_orderstatus AS series, o_orderdate AS ts,
    o_totalprice / 997e0 AS value FROM orders JOIN customer ON o_custkey = c_custkey),
days AS (SELECT series, CAST(ts AS DATE) AS date, avg(value) AS value FROM raw GROUP BY 1, 2),
spine AS ({spine_sql('orders', 'o_orderdate')}),
cells AS (SELECT s.series, spine.date, days.value,
    row_number() OVER (PARTITION BY s.series ORDER BY spine.date) AS p
    FROM (SELECT DISTINCT series FROM days) s CROSS JOIN spine
    LEFT JOIN days ON days.series = s.series AND days.date = spine.date)
"""


def line_sql(src: str, out: str, reach: int | None, value: str = "value", key: str = "series") -> str:
    """CTEs that interpolate `value` of `src` (key, p, value, ...) linearly."""
    limit = "TRUE" if reach is None else f"(p - pp <= {reach} OR np - p <= {reach})"
    return f""", {out}_n AS (SELECT *,
    max(CASE WHEN {value} IS NOT NULL THEN p END) OVER (PARTITION BY {key} ORDER BY p) AS pp,
    min(CASE WHEN {value} IS NOT NULL THEN p END) OVER (PARTITION BY {key} ORDER BY p
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np FROM {src}),
{out} AS (SELECT n.* EXCLUDE (pp, np) REPLACE (CASE WHEN n.{value} IS NOT NULL THEN n.{value}
    WHEN NOT coalesce({limit.replace('p - pp', 'n.p - n.pp').replace('np - p ', 'n.np - n.p ')}, FALSE) THEN NULL
    WHEN a.{value} IS NOT NULL AND b.{value} IS NOT NULL
      THEN a.{value} + (b.{value} - a.{value}) * (n.p - n.pp) / (n.np - n.pp)
    ELSE coalesce(a.{value}, b.{value}) END AS {value})
  FROM {out}_n n LEFT JOIN {src} a ON a.{key} = n.{key} AND a.p = n.pp
  LEFT JOIN {src} b ON b.{key} = n.{key} AND b.p = n.np)"""


def carry_sql(src: str, out: str, k: int, value: str = "value", key: str = "series") -> str:
    """CTEs that copy forward, then backward, at most k rows."""
    return f""", {out}_f AS (SELECT * REPLACE (coalesce({value}, last_value({value} IGNORE NULLS) OVER (
    PARTITION BY {key} ORDER BY p ROWS BETWEEN {k} PRECEDING AND CURRENT ROW)) AS {value}) FROM {src}),
{out} AS (SELECT * REPLACE (coalesce({value}, first_value({value} IGNORE NULLS) OVER (
    PARTITION BY {key} ORDER BY p ROWS BETWEEN CURRENT ROW AND {k} FOLLOWING)) AS {value}) FROM {out}_f)"""


# --- dense daily series ----------------------------------------------------------------------------

def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means of lineitem by line status; PM10 only knows returned rows."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("series"), F.col("l_shipdate").cast("date").alias("date"),
        "l_quantity", "l_returnflag", "l_discount", "l_tax")
    returned = F.col("l_returnflag") == "R"
    days = li.groupBy("series", "date").agg(
        F.round(F.avg("l_quantity"), 6).alias("PM2_5"),
        F.round(F.avg(F.when(returned, F.col("l_quantity"))) * 1.6, 6).alias("PM10"),
        F.round(F.avg("l_discount") * 100.0 - 5.0, 6).alias("wind_u10m"),
        F.round(F.avg("l_tax") * 100.0 - 4.0, 6).alias("wind_v10m"),
        F.round(F.avg(F.when(returned, F.col("l_tax"))) * 100.0, 6).alias("wind_speed"))
    names = ["PM2_5", "PM10", "wind_u10m", "wind_v10m", "wind_speed"]
    return resample.on_spine(days, ["series"], *span(spark, sf_dir, "lineitem", "l_shipdate"), names)


DENSE_SQL = f"""
WITH days AS (SELECT l_linestatus AS series, CAST(l_shipdate AS DATE) AS date,
    round(avg(l_quantity), 6) AS PM2_5, round(avg(l_quantity) FILTER (WHERE l_returnflag = 'R') * 1.6e0, 6) AS PM10,
    round(avg(l_discount) * 100e0 - 5e0, 6) AS wind_u10m, round(avg(l_tax) * 100e0 - 4e0, 6) AS wind_v10m,
    round(avg(l_tax) FILTER (WHERE l_returnflag = 'R') * 100e0, 6) AS wind_speed
    FROM lineitem GROUP BY 1, 2),
spine AS ({spine_sql('lineitem', 'l_shipdate')}),
dense AS (SELECT s.series, spine.date, days.* EXCLUDE (series, date),
    row_number() OVER (PARTITION BY s.series ORDER BY spine.date) AS p
    FROM (SELECT DISTINCT series FROM days) s CROSS JOIN spine
    LEFT JOIN days ON days.series = s.series AND days.date = spine.date)
"""
