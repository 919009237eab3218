import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazegrid import catalog
from hazegrid.operators import chunks, forecast, learn
from hazegrid.operators.windows import lead_name
from tests.util import DAY0, frame, same


def day():
    return chunks.day(F.col("date"))


def history(spark, n=240, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, n)
    y = 3 * np.roll(x, 1) + rng.normal(0, 0.2, n) + 40
    return frame(spark, {"x": x, "z": rng.normal(5, 2, n), "aqi": y})


def test_split_sizes_follow_the_share(spark):
    df = frame(spark, {"aqi": list(np.arange(500.0))})
    rows = learn.split_by_time(learn.supervised(df, ["series"], day(), [], ["aqi"], (1, 30), 64), ["series"], day(), length=64)
    sizes = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    assert sizes == {"train": int(0.8 * 470), "test": 470 - int(0.8 * 470)}
    last = rows.filter("split = 'train'").agg(F.max("date")).first()[0]
    assert last < rows.filter("split = 'test'").agg(F.min("date")).first()[0]


def test_scale_of_a_constant_column_is_one(spark):
    df = frame(spark, {"a": [3.0] * 9, "b": list(range(9))})
    assert learn.RobustScale.fit(df, ["a", "b"]).params == {"a": (3.0, 1.0), "b": (4.0, 4.0)}


@pytest.fixture(scope="module")
def trained(spark):
    rows = learn.supervised(history(spark), ["series"], day(), ["x", "z"], ["aqi"], (1, 7))
    rows = learn.split_by_time(rows, ["series"], day()).cache()
    return rows, learn.train(rows, ["x", "z"], ["aqi"], (1, 7), trees=8, depth=4, rounds=5, round_depth=3)


def matrices(rows, horizon):
    pdf = rows.filter("split = 'train'").toPandas()
    y = pdf[lead_name("aqi", horizon)]

    def scaled(s):
        q = s.quantile([0.25, 0.5, 0.75]).to_numpy()
        return ((s - q[1]) / (q[2] - q[0])).to_numpy()
    return np.column_stack([scaled(pdf["x"]), scaled(pdf["z"])]), scaled(y)


def test_linear_and_ridge_equal_the_closed_form(trained):
    rows, fitted = trained
    x, y = matrices(rows, 1)
    xc, yc = x - x.mean(0), y - y.mean()
    for name, alpha in (("LinearRegression", 0.0), ("Ridge", learn.RIDGE_ALPHA)):
        w = np.linalg.solve(xc.T @ xc + alpha * np.eye(2), xc.T @ yc)
        same(np.array(fitted[1, name].models["aqi"].coefficients), w, 1e-9)


def test_lasso_meets_its_optimality_conditions(trained):
    rows, fitted = trained
    x, y = matrices(rows, 1)
    w = np.array(fitted[1, "Lasso"].models["aqi"].coefficients)
    gradient = (x - x.mean(0)).T @ ((y - y.mean()) - (x - x.mean(0)) @ w) / len(y)
    for g, c in zip(gradient, w):
        assert abs(g - learn.LASSO_ALPHA * np.sign(c)) < 1e-4 if c else abs(g) <= learn.LASSO_ALPHA + 1e-4


def test_learners_find_the_dependence_and_rank_first_horizon_higher(trained):
    rows, fitted = trained
    scored = learn.metrics(learn.predictions(rows, fitted.values()))
    r2 = {(r["horizon"], r["model"]): r["r2_test"] for r in scored.collect()}
    assert set(r2) == {(h, m) for h in (1, 7) for m in learn.LEARNERS}
    assert r2[1, "LinearRegression"] > 0.95 and r2[1, "RandomForest"] > 0.5 and r2[7, "Ridge"] < 0.3
    board = learn.leaderboard(learn.weighted_scores(scored)).collect()
    assert {(r["horizon"], r["rank"]) for r in board} == {(1, 1), (1, 2), (7, 1), (7, 2)}


def test_metrics_of_flat_and_zero_mean_targets(spark):
    rows = [("flat", s, 2.0, 2.0) for s in ("train", "test")] * 2 + [("off", s, 2.0, 3.0) for s in ("train", "test")] * 2
    rows += [("zero", "train", 1.0, 1.0), ("zero", "test", -1.0, 0.0), ("zero", "test", 1.0, 0.0)]
    df = spark.createDataFrame([(1, "m", t, s, y, p) for t, s, y, p in rows],
                               "horizon int, model string, target string, split string, y double, yhat double")
    got = {r["target"]: r for r in learn.metrics(df).collect()}
    assert (got["flat"]["r2_test"], got["off"]["r2_test"], got["zero"]["r2_test"]) == (1.0, 0.0, 0.0)
    assert got["off"]["normalized_rmse_test"] == 0.5 and got["zero"]["normalized_mae_test"] == 1.0


def test_weights_sum_to_the_declared_total():
    assert sum(catalog.TARGET_WEIGHTS.values()) == 18.5 and set(catalog.TARGET_WEIGHTS) == set(catalog.TARGETS)


def test_models_survive_saving(spark, trained, tmp_path):
    rows, fitted = trained
    learn.save(spark, {(1, 1): fitted[1, "RandomForest"], (7, 2): fitted[7, "GradientBoosting"]}, str(tmp_path))
    back = learn.load(spark, str(tmp_path))
    for key, f in {(1, 1): fitted[1, "RandomForest"], (7, 2): fitted[7, "GradientBoosting"]}.items():
        a = f.predict(rows).orderBy("date").select("aqi_pred").toPandas()
        b = back[key].predict(rows).orderBy("date").select("aqi_pred").toPandas()
        same(a["aqi_pred"], b["aqi_pred"])


@pytest.mark.parametrize("days,horizon,recursive", [
    (1, 1, False), (2, 1, True), (3, 1, True), (4, 7, False), (6, 7, False), (7, 7, False), (8, 7, False), (14, 7, False),
    (15, 30, False), (29, 30, False), (30, 30, False), (31, 30, False), (60, 30, False), (61, 365, False),
    (365, 365, False), (366, 365, False)])
def test_horizon_for_every_distance(spark, days, horizon, recursive):
    row = spark.range(1).select(*[c.alias(n) for n, c in forecast.choose_horizon(F.lit(days)).items()]).first()
    assert (row["horizon"], row["recursive"]) == (horizon, recursive)


def test_base_day_in_and_after_the_data(spark):
    def base(day, last):
        cols = forecast.choose_base(F.lit(day).cast("date"), F.lit(last).cast("date"))
        return tuple(spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first())
    assert base("2025-09-01", "2025-09-30") == (dt.date(2025, 8, 31), 1)
    assert base("2025-11-20", "2025-09-30") == (dt.date(2025, 9, 30), 51)
    assert base("2025-11-20", "2025-11-10") == (dt.date(2025, 11, 5), 15)
    assert base("2026-01-02", "2025-11-10") == (dt.date(2025, 11, 10), 53)


def test_recursive_forecast_matches_a_loop_over_days(spark):
    n, steps = 40, 9
    rng = np.random.default_rng(6)
    values = rng.normal(50, 10, n)
    s = pd.Series(values)
    names = ["PM2_5_lag1", "PM2_5_lag7", "PM2_5_rolling7_mean", "PM2_5_rolling7_std", "month", "other"]
    table = pd.DataFrame({
        "PM2_5": s, "PM2_5_lag1": s.shift(1).bfill(), "PM2_5_lag7": s.shift(7).bfill(),
        "PM2_5_rolling7_mean": s.rolling(7, min_periods=1).mean(),
        "PM2_5_rolling7_std": s.rolling(7, min_periods=1).std().bfill(), "other": rng.normal(size=n)})
    df = frame(spark, {c: table[c] for c in table}).withColumn("month", F.month("date"))
    weights = np.array([0.5, 0.2, 0.1, -0.3, 0.7, 2.0])

    class Linear(learn.Forecaster):
        def predict(self, d, suffix="_pred"):
            total = sum((F.col(f) * float(w) for f, w in zip(names, weights)), F.lit(1.0))
            return d.withColumn("PM2_5" + suffix, total)

    model = Linear(1, "x", names, ["PM2_5"], None, None)
    got = forecast.recursive(df, model, steps, history=df, keys=["series"]).toPandas().sort_values("base_date")
    for i in (0, 20, 33, 39):
        state, seen = {c: table[c][i] for c in table}, []
        state["month"] = (DAY0 + dt.timedelta(days=i)).month
        for k in range(1, steps + 1):
            seen.append(1.0 + sum(w * state[f] for f, w in zip(names, weights)))
            date = DAY0 + dt.timedelta(days=i + k)
            state["month"], state["PM2_5_lag1"] = date.month, seen[-1]
            if len(seen) >= 7:
                state["PM2_5_lag7"] = seen[-7]
            elif len(seen) == 6 and 0 <= i + k - 7 < n:
                state["PM2_5_lag7"] = values[i + k - 7]
            state["PM2_5_rolling7_mean"], state["PM2_5_rolling7_std"] = np.mean(seen[-7:]), np.std(seen[-7:])
        row = got.iloc[i]
        same([row[f"PM2_5_d{k}"] for k in range(1, steps + 1)], seen, 1e-9)
