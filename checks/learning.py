"""Supervised tables, models and forecasts (M rows)."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, functions as F

from checks import query
from checks.bindings import AIR_SQL, CATEGORY_SQL, DENSE_SQL, INDEX_SQL, air, day, dense, index, r6, table
from hazegrid import catalog
from hazegrid.functions.numeric import clip
from hazegrid.operators import clean, forecast, learn, linear, trees, windows
from hazegrid.operators.windows import lead_name
from hazegrid.plans import forecast as forecast_job
from hazegrid.session import scratch, stage

KEYS = ["series"]
HORIZONS = catalog.HORIZONS
TARGETS = ("PM2_5", "wind_u10m")
_W = "OVER (PARTITION BY series ORDER BY date)"


@query("M1_feature_selection", AIR_SQL + """SELECT l_orderkey, l_linenumber, year, month, day, weekday, day_of_year,
  is_weekend, season, round(AOD_550, 6) AS AOD_550, round(NO2_total / 1e15, 6) AS NO2_total, SO2_surface, dew_point,
  wind_u10m, wind_v10m FROM air""")
def feature_selection(spark, sf_dir):
    df = air(spark, sf_dir).drop("series")
    out = df.select(*clean.feature_columns(df.columns))
    return out.withColumn("AOD_550", F.round("AOD_550", 6)).withColumn(
        "NO2_total", F.round(F.col("NO2_total") / 1e15, 6))


_LEADS = ", ".join(f"lead({t}, {h}) {_W} AS {t}_h{h}" for t in TARGETS for h in HORIZONS)
_ALL = " AND ".join(f"{t}_h{h} IS NOT NULL" for t in TARGETS for h in HORIZONS)
SUPERVISED_SQL = DENSE_SQL + f""", lead_rows AS (SELECT series, date, PM2_5, wind_u10m,
  coalesce(PM10, (SELECT avg(PM10) FROM dense)) AS PM10, {_LEADS} FROM dense),
sup AS (SELECT *, row_number() {_W} - 1 AS row_no, count(*) OVER (PARTITION BY series) AS n_rows
  FROM lead_rows WHERE {_ALL}),
split AS (SELECT *, CASE WHEN row_no < floor(n_rows * 0.8e0) THEN 'train' ELSE 'test' END AS split FROM sup)
"""


def supervised_rows(spark, sf_dir):
    df = dense(spark, sf_dir).select("series", "date", "PM2_5", "wind_u10m", "PM10")
    return learn.supervised(df, KEYS, day(), ["PM10"], TARGETS, HORIZONS)


def split_rows(spark, sf_dir):
    return learn.split_by_time(supervised_rows(spark, sf_dir), KEYS, day())


@query("M2_multi_horizon_targets", SUPERVISED_SQL + "SELECT series, date, round(PM10, 6) AS PM10, " + ", ".join(
    f"{t}_h{h}" for t in TARGETS for h in HORIZONS) + " FROM sup")
def multi_horizon_targets(spark, sf_dir):
    return supervised_rows(spark, sf_dir).drop("PM2_5", "wind_u10m").withColumn("PM10", F.round("PM10", 6))


@query("M3_chronological_split", SUPERVISED_SQL + "SELECT series, date, split FROM split")
def chronological_split(spark, sf_dir):
    return split_rows(spark, sf_dir).select("series", "date", "split")


_SCALED = ("PM10", "PM2_5", "PM2_5_h1", "wind_u10m_h30")


@query("M4_robust_scale", SUPERVISED_SQL + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(median({c}), 9) AS center, round(CASE WHEN quantile_cont({c}, 0.75) =
    quantile_cont({c}, 0.25) THEN 1e0 ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END, 9) AS scale
    FROM split WHERE split = 'train'""" for c in _SCALED))
def robust_scale(spark, sf_dir):
    train = split_rows(spark, sf_dir).filter(F.col("split") == "train")
    # Values of six decimals, interpolated: ties of the sixth decimal would round either way.
    return r6(learn.quartile_table(train, _SCALED), digits=9)


# --- one feature, one target: least squares has a closed form ------------------------------------

SPINE_SQL = INDEX_SQL + """, sp AS (SELECT days.date, aqi, PM2_5 FROM (SELECT CAST(d AS DATE) AS date FROM generate_series(
  (SELECT min(date) FROM aqi_data), (SELECT max(date) FROM aqi_data), INTERVAL 1 DAY) g(d)) days
  LEFT JOIN aqi_data USING (date))
"""
_STATION_SQL = SPINE_SQL + ", st AS (SELECT date, coalesce(PM2_5, (SELECT avg(PM2_5) FROM sp)) AS PM2_5, aqi, " + ", ".join(
    f"lead(aqi, {h}) OVER (ORDER BY date) AS aqi_h{h}" for h in HORIZONS) + """ FROM sp),
sup AS (SELECT *, row_number() OVER (ORDER BY date) - 1 AS row_no, count(*) OVER () AS n_rows FROM st
  WHERE """ + " AND ".join(f"aqi_h{h} IS NOT NULL" for h in HORIZONS) + """),
split AS (SELECT *, CASE WHEN row_no < floor(n_rows * 0.8e0) THEN 'train' ELSE 'test' END AS split FROM sup),
fit AS (""" + " UNION ALL ".join(
    f"SELECT {h} AS horizon, regr_slope(aqi_h{h}, PM2_5) AS b, regr_intercept(aqi_h{h}, PM2_5) AS a "
    "FROM split WHERE split = 'train'" for h in HORIZONS) + """)
"""


def station(spark, sf_dir):
    """The daily index as one series on its spine."""
    days = index(spark, sf_dir).select(F.lit("all").alias("series"), "date", "PM2_5", "aqi")
    spans = days.groupBy("series").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    spine = spans.select("series", F.explode(F.sequence("a", "b")).alias("date"))
    return spine.join(days, ["series", "date"], "left")


def station_split(spark, sf_dir):
    rows = learn.supervised(station(spark, sf_dir), KEYS, day(), ["PM2_5"], ["aqi"], HORIZONS)
    return learn.split_by_time(rows, KEYS, day())


def _fitted(spark, sf_dir, names=("LinearRegression",), **sizes):
    frame = station_split(spark, sf_dir)
    return frame, learn.train(frame, ["PM2_5"], ["aqi"], HORIZONS, names, **sizes)


_PREDICTED_SQL = " UNION ALL ".join(
    f"""SELECT CAST({h} AS INTEGER) AS horizon, date, split, aqi_h{h} AS y, round(a + b * PM2_5, 4) AS yhat
    FROM split, fit WHERE fit.horizon = {h}""" for h in HORIZONS)


@query("M5_least_squares_fit", _STATION_SQL + """SELECT CAST(horizon AS INTEGER) AS horizon, round(a, 4) AS intercept,
  round(b, 6) AS slope FROM fit""")
def least_squares_fit(spark, sf_dir):
    _, fitted = _fitted(spark, sf_dir)
    rows = []
    for (h, _), f in fitted.items():
        b_scaled, a_scaled = f.models["aqi"].coefficients[0], f.models["aqi"].intercept
        (cx, sx), (cy, sy) = f.scale_x.params["PM2_5"], f.scale_y.params["aqi"]
        slope = b_scaled * sy / sx
        rows.append((h, round(cy + a_scaled * sy - slope * cx, 4), round(slope, 6)))
    return spark.createDataFrame(rows, "horizon int, intercept double, slope double")


# --- every series on its own, all targets and horizons from one pass -----------------------------

_LABELS = [lead_name(t, h) for t in TARGETS for h in HORIZONS]
_SEASON = "dayofyear(date) / 100e0"
_MOMENTS_SQL = SUPERVISED_SQL + ", tall AS (" + " UNION ALL ".join(
    f"SELECT series, '{y}' AS label, PM10 AS x1, {_SEASON} AS x2, {y} AS y FROM split WHERE split = 'train'" for y in _LABELS) + """),
m AS (SELECT series, label, count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) * count(*) AS s11, var_pop(x2) * count(*) AS s22,
  covar_pop(x1, x2) * count(*) AS s12, covar_pop(x1, y) * count(*) AS s1y, covar_pop(x2, y) * count(*) AS s2y FROM tall GROUP BY ALL)
"""
_TWO_SQL = " UNION ALL ".join(
    f"""SELECT series, '{name}' AS learner, label, n, my - b1 * m1 - b2 * m2 AS a, b1, b2 FROM (SELECT *,
  ((s22 + {alpha}) * s1y - s12 * s2y) / ((s11 + {alpha}) * (s22 + {alpha}) - s12 * s12) AS b1,
  ((s11 + {alpha}) * s2y - s12 * s1y) / ((s11 + {alpha}) * (s22 + {alpha}) - s12 * s12) AS b2 FROM m)"""
    for name, alpha in (("LinearRegression", "0e0"), ("Ridge", f"{linear.RIDGE_ALPHA}e0")))


def _train_rows(spark, sf_dir):
    return split_rows(spark, sf_dir).filter("split = 'train'").withColumn("season", F.dayofyear("date") / 100)


@query("M5_linear_family", _MOMENTS_SQL + f"SELECT series, learner, label, n, round(a, 5) AS a, round(b1, 6) AS b1, round(b2, 6) AS b2 FROM ({_TWO_SQL})")
def linear_family(spark, sf_dir):
    """Least squares and ridge with two features against the solution by hand."""
    found = linear.planes(_train_rows(spark, sf_dir), ["PM10", "season"], _LABELS, ("LinearRegression", "Ridge"), KEYS)
    return found.select("series", "learner", "label", "n", F.round("intercept", 5).alias("a"), F.round(F.col("coefficients")[0], 6).alias("b1"),
                        F.round(F.col("coefficients")[1], 6).alias("b2"))


@query("M5_lasso", _MOMENTS_SQL + f"""SELECT series, label, n, round(my - b1 * m1, 5) AS a, round(b1, 6) AS b1 FROM (
  SELECT *, sign(s1y) * greatest(abs(s1y) - n * {linear.LASSO_ALPHA}, 0) / s11 AS b1 FROM m)""")
def lasso(spark, sf_dir):
    """With one feature, lasso is least squares moved towards zero."""
    found = linear.planes(_train_rows(spark, sf_dir), ["PM10"], _LABELS, ("Lasso",), KEYS)
    return found.select("series", "label", "n", F.round("intercept", 5).alias("a"), F.round(F.col("coefficients")[0], 6).alias("b1"))


# --- one tree of one cut, for both targets at once: the cut is drawn between the least and largest value ---

_RNG = np.random.default_rng([42, 0, 0])
_RNG.random((len(HORIZONS), 1))  # the draw of the features, of which there is one
_DRAWN = [float(u) for u in _RNG.random((len(HORIZONS), 1))[:, 0]]


@query("M5_extra_tree_stump", SUPERVISED_SQL + """, train AS (SELECT * FROM split WHERE split = 'train'),
span AS (SELECT min(PM10) AS low, max(PM10) AS high FROM train)""" + " UNION ALL ".join(
    f"""SELECT CAST({h} AS INTEGER) AS horizon, round(cut, 6) AS cut, """ + ", ".join(
        f"round(avg({t}_h{h}) FILTER (WHERE PM10 {op} cut), 6) AS {t}_{side}" for t in TARGETS for side, op in (("below", "<="), ("above", ">")))
    + f" FROM train, (SELECT low + {u!r}::DOUBLE * (high - low) AS cut FROM span) GROUP BY cut" for h, u in zip(HORIZONS, _DRAWN)))
def extra_tree_stump(spark, sf_dir):
    rows = split_rows(spark, sf_dir).filter("split = 'train'")
    ready = stage(rows.select(F.array("PM10").alias("x"), F.array(*[lead_name(t, h) for h in HORIZONS for t in TARGETS]).alias("y")), "stump")
    found = trees.fit(ready, 1, len(TARGETS), len(HORIZONS), trees=1, depth=1)
    out = []
    for h, f in zip(HORIZONS, found):
        below, above = f.value[f.left[0]], f.value[f.left[0] + 1]
        out.append((h, float(f.cut[0]), *(float(side[k]) for k in range(len(TARGETS)) for side in (below, above))))
    names = [f"{t}_{side}" for t in TARGETS for side in ("below", "above")]
    df = spark.createDataFrame(out, "horizon int, cut double, " + ", ".join(f"{n} double" for n in names))
    return df.select("horizon", *(F.round(c, 6).alias(c) for c in ("cut", *names)))


@query("M5_all_learners", f"""SELECT CAST(h AS INTEGER) AS horizon, m AS model, 'aqi' AS target, true AS finite, true AS fits
FROM (VALUES {', '.join(f"({h})" for h in HORIZONS)}) a(h), (VALUES {', '.join(f"('{m}')" for m in learn.LEARNERS)}) b(m)""")
def all_learners(spark, sf_dir):
    """Every learner at a small size. Fitted values differ by implementation; all must be finite and no worse in training than the mean by a tenth."""
    frame, fitted = _fitted(spark, sf_dir, learn.LEARNERS, trees=10, depth=5, rounds=5, round_depth=3)
    scores = learn.metrics(learn.predictions(frame, fitted.values()))
    numbers = [F.col(c) for c, t in scores.dtypes if t == "double"]
    finite = F.lit(True)
    for c in numbers:
        finite = finite & F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    return scores.select("horizon", "model", "target", finite.alias("finite"), (F.col("r2_train") > -0.1).alias("fits"))


@query("M6_batch_prediction", _STATION_SQL + _PREDICTED_SQL)
def batch_prediction(spark, sf_dir):
    frame, fitted = _fitted(spark, sf_dir)
    parts = [
        f.predict(frame).select(F.lit(h).alias("horizon"), "date", "split", F.col(f"aqi_h{h}").alias("y"),
                                F.round("aqi_pred", 4).alias("yhat"))
        for (h, _), f in fitted.items()]
    return reduce(DataFrame.unionByName, parts)


@query("M10_saved_models", _STATION_SQL + _PREDICTED_SQL)
def saved_models(spark, sf_dir):
    frame, fitted = _fitted(spark, sf_dir)
    path = scratch(spark, "models")
    learn.save(spark, {(h, 1): f for (h, _), f in fitted.items()}, path)
    parts = [
        f.predict(frame).select(F.lit(h).alias("horizon"), "date", "split", F.col(f"aqi_h{h}").alias("y"),
                                F.round("aqi_pred", 4).alias("yhat"))
        for (h, _), f in sorted(learn.load(spark, path).items(), key=lambda x: x[0])]
    return reduce(DataFrame.unionByName, parts)


# --- scores of naive forecasts -----------------------------------------------------------------------

def naive(spark, sf_dir):
    """Today's value and the training mean as forecasts of every target and horizon."""
    rows = split_rows(spark, sf_dir)
    train_only = [F.avg(F.when(F.col("split") == "train", F.col(t))).alias(t) for t in TARGETS]
    means = rows.agg(F.struct(*train_only)).scalar()
    pairs = F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.lit(model).alias("model"), F.lit(t).alias("target"),
                 F.col(f"{t}_h{h}").alias("y"), guess.alias("yhat"))
        for h in HORIZONS for t in TARGETS
        for model, guess in (("today", F.coalesce(F.col(t), means.getField(t))), ("mean", means.getField(t)))])
    return rows.select("split", F.inline(pairs))


NAIVE_SQL = SUPERVISED_SQL + ", pred AS (" + " UNION ALL ".join(
    f"""SELECT split, CAST({h} AS INTEGER) AS horizon, '{m}' AS model, '{t}' AS target, {t}_h{h} AS y, {g} AS yhat
    FROM split""" for h in HORIZONS for t in TARGETS for m, g in (
        ("today", f"coalesce({t}, (SELECT avg({t}) FROM split WHERE split = 'train'))"),
        ("mean", f"(SELECT avg({t}) FROM split WHERE split = 'train')"))) + """),
one AS (SELECT horizon, model, target, split, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs(y - yhat)) AS mae,
  1 - sum((y - yhat) * (y - yhat)) / sum((y - m) * (y - m)) AS r2, abs(avg(y)) AS level, stddev_pop(y) AS sd
  FROM (SELECT *, avg(y) OVER (PARTITION BY horizon, model, target, split) AS m FROM pred) GROUP BY 1, 2, 3, 4),
met AS (SELECT a.horizon, a.model, a.target, a.rmse AS rmse_train, a.mae AS mae_train, a.r2 AS r2_train,
  b.rmse AS rmse_test, b.mae AS mae_test, b.r2 AS r2_test,
  b.rmse / CASE WHEN b.level > 1e-6 THEN b.level WHEN b.sd > 1e-6 THEN b.sd ELSE 1 END AS normalized_rmse_test,
  b.mae / CASE WHEN b.level > 1e-6 THEN b.level WHEN b.sd > 1e-6 THEN b.sd ELSE 1 END AS normalized_mae_test
  FROM one a JOIN one b ON a.horizon = b.horizon AND a.model = b.model AND a.target = b.target
  WHERE a.split = 'train' AND b.split = 'test'),
score AS (SELECT horizon, model, sum(w * r2_test) / sum(w) AS overall_r2_test,
  sum(w * normalized_rmse_test) / sum(w) AS overall_rmse_test, 0e0 AS aqi_r2_test
  FROM (SELECT *, CASE target WHEN 'PM2_5' THEN 2e0 ELSE 1e0 END AS w FROM met) GROUP BY 1, 2)
"""
_METRICS = ("rmse_train", "mae_train", "r2_train", "rmse_test", "mae_test", "r2_test", "normalized_rmse_test",
            "normalized_mae_test")


@query("M7_metrics", NAIVE_SQL + "SELECT horizon, model, target, " + ", ".join(
    f"round({m}, 4) AS {m}" for m in _METRICS) + " FROM met")
def metrics(spark, sf_dir):
    return r6(learn.metrics(naive(spark, sf_dir)), digits=4)


@query("M8_weighted_scores", NAIVE_SQL + """SELECT horizon, model, round(overall_r2_test, 4) AS overall_r2_test,
  round(overall_rmse_test, 4) AS overall_rmse_test, aqi_r2_test FROM score""")
def weighted_scores(spark, sf_dir):
    return r6(learn.weighted_scores(learn.metrics(naive(spark, sf_dir))), digits=4)


@query("M9_leaderboard", NAIVE_SQL + """SELECT horizon, model, round(overall_r2_test, 4) AS overall_r2_test,
  CAST(row_number() OVER (PARTITION BY horizon ORDER BY overall_r2_test DESC, model) AS INTEGER) AS rank FROM score""")
def leaderboard(spark, sf_dir):
    scores = learn.weighted_scores(learn.metrics(naive(spark, sf_dir)))
    return r6(learn.leaderboard(scores).select("horizon", "model", "overall_r2_test", "rank"), digits=4)


# --- forecast requests -----------------------------------------------------------------------------------

@query("M11_horizon_choice", """WITH d AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) * l_linenumber AS INTEGER) AS days
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT *, CAST(CASE WHEN days = 1 THEN 1 WHEN days IN (7, 30, 365) THEN days WHEN days > 365 THEN 365 WHEN days > 60 THEN 365
  WHEN days > 30 THEN 30 WHEN days > 14 THEN 30 WHEN days > 7 THEN 7 WHEN days > 3 THEN 7 ELSE 1 END AS INTEGER) AS horizon,
  days IN (2, 3) AS recursive FROM d""")
def horizon_choice(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    days = (F.datediff("l_shipdate", "o_orderdate") * F.col("l_linenumber")).alias("days")
    return lines.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("date"), days).select(
        "*", *[c.alias(n) for n, c in forecast.choose_horizon(F.col("days")).items()])


# History and requests moved to late 2025, where the fixed base day lies.
_SHIFT = 8800


_BASE_DAYS_SQL = INDEX_SQL + f""", hist AS (SELECT date + {_SHIFT} AS date FROM aqi_data),
req AS (SELECT DISTINCT CAST(l_shipdate AS DATE) + {_SHIFT} + l_linenumber * 10 AS forecast_date FROM lineitem),
based AS (SELECT forecast_date, CASE WHEN forecast_date <= (SELECT max(date) FROM hist) THEN forecast_date - 1
  WHEN forecast_date BETWEEN DATE '2025-11-05' AND DATE '2025-12-31' AND DATE '2025-11-05' <= (SELECT max(date) FROM hist)
    THEN DATE '2025-11-05' ELSE (SELECT max(date) FROM hist) END AS base_date FROM req)
SELECT forecast_date, base_date, CAST(forecast_date - base_date AS INTEGER) AS days_ahead"""


def _planned(spark, sf_dir):
    history = index(spark, sf_dir).select(F.date_add("date", _SHIFT).alias("date"))
    requests = table(spark, sf_dir, "lineitem").select(F.date_add(
        F.col("l_shipdate").cast("date"), F.lit(_SHIFT) + F.col("l_linenumber") * 10).alias("forecast_date")).distinct()
    return forecast.plan_requests(requests, history)


@query("M12_base_day_choice", _BASE_DAYS_SQL + " FROM based WHERE base_date IN (SELECT date FROM hist)")
def base_day_choice(spark, sf_dir):
    return _planned(spark, sf_dir).filter("unanswered IS NULL").select("forecast_date", "base_date", "days_ahead")


@query("M12_all_requests", _BASE_DAYS_SQL + """, CASE WHEN base_date NOT IN (SELECT date FROM hist) THEN 'no data of the base day' END
  AS unanswered FROM based""")
def all_requests(spark, sf_dir):
    return _planned(spark, sf_dir).select("forecast_date", "base_date", "days_ahead", "unanswered")


def _requests(spark, sf_dir):
    dates = table(spark, sf_dir, "orders").select(
        F.date_add(F.col("o_orderdate").cast("date"), 120).alias("forecast_date")).distinct()
    return forecast.plan_requests(dates, station(spark, sf_dir)).filter("unanswered IS NULL").drop("unanswered")


_REQUESTS_SQL = """, lastday AS (SELECT max(date) AS d FROM sp),
based AS (SELECT forecast_date, CASE WHEN forecast_date <= d THEN forecast_date - 1 ELSE d END AS base_date FROM
  (SELECT DISTINCT CAST(o_orderdate AS DATE) + 120 AS forecast_date FROM orders), lastday),
req AS (SELECT *, CAST(forecast_date - base_date AS INTEGER) AS days_ahead FROM based
  WHERE base_date IN (SELECT date FROM sp)),
reqh AS (SELECT *, CASE WHEN days_ahead <= 3 THEN 1 WHEN days_ahead <= 14 THEN 7 WHEN days_ahead <= 60 THEN 30 ELSE 365 END
  AS horizon FROM req)
"""


@query("M13_direct_forecast", _STATION_SQL + _REQUESTS_SQL + """SELECT forecast_date, base_date, days_ahead,
  CAST(horizon AS INTEGER) AS horizon, round(least(greatest(a + b * PM2_5, 0), 500), 4) AS aqi_pred
FROM reqh LEFT JOIN fit USING (horizon) LEFT JOIN st ON st.date = base_date WHERE days_ahead NOT IN (2, 3)""")
def direct_forecast(spark, sf_dir):
    _, fitted = _fitted(spark, sf_dir)
    requests = _requests(spark, sf_dir).filter(~F.col("recursive"))
    history = forecast.fill_features(station(spark, sf_dir).drop("series", "aqi"), ["PM2_5"])
    out = forecast.direct(requests, history, {h: f for (h, _), f in fitted.items()})
    return r6(out.drop("recursive"), digits=4)


_LAGGED_SQL = SPINE_SQL + """, st AS (SELECT date, PM2_5, lag(PM2_5) OVER (ORDER BY date) AS PM2_5_lag1,
  lead(PM2_5) OVER (ORDER BY date) AS y FROM sp),
filled AS (SELECT * REPLACE (coalesce(PM2_5_lag1, (SELECT avg(PM2_5_lag1) FROM st)) AS PM2_5_lag1) FROM st),
sup AS (SELECT *, row_number() OVER (ORDER BY date) - 1 AS row_no, count(*) OVER () AS n_rows FROM filled
  WHERE y IS NOT NULL),
fit AS (SELECT regr_slope(y, PM2_5_lag1) AS b, regr_intercept(y, PM2_5_lag1) AS a FROM sup
  WHERE row_no < floor(n_rows * 0.8e0))
"""


@query("M14_recursive_forecast", _LAGGED_SQL + """, one AS (SELECT date, a, b, a + b * PM2_5_lag1 AS d1 FROM filled, fit)
SELECT date AS base_date, round(d1, 4) AS PM2_5_d1, round(a + b * d1, 4) AS PM2_5_d2,
  round(a + b * (a + b * d1), 4) AS PM2_5_d3 FROM one""")
def recursive_forecast(spark, sf_dir):
    days = windows.with_lags(station(spark, sf_dir), KEYS, day(), ["PM2_5"], (1,))
    rows = learn.supervised(days, KEYS, day(), ["PM2_5_lag1"], ["PM2_5"], (1,))
    fitted = learn.train(learn.split_by_time(rows, KEYS, day()), ["PM2_5_lag1"], ["PM2_5"], (1,), ("LinearRegression",))
    base = clean.fill_with_means(days, ["PM2_5_lag1"])
    return r6(forecast.recursive(base, fitted[1, "LinearRegression"], 3), digits=4)


@query("M15_feature_fallback", AIR_SQL + """SELECT l_orderkey, l_linenumber,
  round(coalesce(PM2_5, PM10, (SELECT avg(PM2_5) FROM air), 0), 6) AS PM2_5,
  round(coalesce(SO2_column, (SELECT avg(SO2_column) FROM air), 0), 6) AS SO2_column FROM air""")
def feature_fallback(spark, sf_dir):
    out = forecast.fill_features(air(spark, sf_dir), ["PM2_5", "SO2_column"], {"PM2_5": F.col("PM10")})
    return r6(out.select("l_orderkey", "l_linenumber", "PM2_5", "SO2_column"))


@query("M16_back_test", SPINE_SQL + _REQUESTS_SQL + """, p AS (SELECT forecast_date, base_date,
  CASE WHEN b.aqi IS NOT NULL THEN least(greatest(b.aqi * 1.05e0, 0), 500) END AS predicted
  FROM reqh JOIN sp b ON b.date = base_date)
SELECT forecast_date, base_date, round(predicted, 6) AS predicted, aqi AS actual, round(abs(predicted - aqi), 6) AS error,
  round(abs(predicted - aqi) * 100e0 / aqi, 6) AS error_pct FROM p LEFT JOIN sp ON date = forecast_date""")
def back_test(spark, sf_dir):
    history = station(spark, sf_dir)
    base = history.select(F.col("date").alias("base_date"), clip(F.col("aqi") * 1.05, 0.0, 500.0).alias("predicted"))
    forecasts = _requests(spark, sf_dir).join(base, "base_date").select("forecast_date", "base_date", "predicted")
    return r6(forecast.back_test(forecasts, history))


_COLD = catalog.ACTION_COLD
_FLOWER = f"""'{catalog.ACTION_FLOWER[0]}' || strftime(forecast_date, '%d/%m') || '{catalog.ACTION_FLOWER[1]}'"""


@query("E4_forecasts", _STATION_SQL + _REQUESTS_SQL + f""", p AS (SELECT forecast_date, base_date, days_ahead, horizon,
  days_ahead IN (2, 3) AS recursive, least(greatest(a + b * PM2_5, 0), 500) AS predicted
  FROM reqh LEFT JOIN fit USING (horizon) LEFT JOIN st ON st.date = base_date),
named AS (SELECT *, {CATEGORY_SQL.format('predicted')} AS category FROM p)
SELECT forecast_date, base_date, days_ahead, CAST(horizon AS INTEGER) AS horizon, recursive, round(predicted, 4) AS predicted, category,
  round(sp.aqi, 4) AS actual, round(abs(predicted - sp.aqi), 4) AS error,
  CASE category {' '.join(f"WHEN '{c}' THEN '{t[0]}'" for c, t in catalog.ADVICE.items())} ELSE '{catalog.ADVICE['Moderate'][0]}' END AS title,
  concat_ws(' | ', CASE WHEN month(forecast_date) IN (12, 1, 2) THEN '{_COLD}' END, CASE WHEN month(forecast_date) = 10
    OR (month(forecast_date) = 11 AND day(forecast_date) <= 15) THEN {_FLOWER} END) AS seasonal
FROM named LEFT JOIN sp ON sp.date = forecast_date""")
def forecast_requests(spark, sf_dir):
    """Requests up to four months after each order, with the least-squares models of all horizons."""
    _, fitted = _fitted(spark, sf_dir)
    dates = table(spark, sf_dir, "orders").select(
        F.date_add(F.col("o_orderdate").cast("date"), 120).alias("forecast_date")).distinct()
    days = station(spark, sf_dir).drop("series")
    filled = forecast.fill_features(days, ["PM2_5"])
    out = forecast_job.forecasts(dates, filled, {h: f for (h, _), f in fitted.items()}).filter("unanswered IS NULL")
    seasonal = F.filter("actions", lambda a: a.startswith(_COLD) | a.startswith(catalog.ACTION_FLOWER[0]))
    return r6(out.select("forecast_date", "base_date", "days_ahead", "horizon", "recursive", "predicted", "category", "actual", "error",
                         "title", F.array_join(seasonal, " | ").alias("seasonal")), digits=4)
