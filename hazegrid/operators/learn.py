"""Multi-target, multi-horizon regression on daily tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hazegrid import catalog
from hazegrid.functions.numeric import lookup, ratio
from hazegrid.operators import chunks, clean, linear, scoring, trees
from hazegrid.operators.quantiles import exact_quantiles
from hazegrid.operators.windows import lead_name, with_leads
from hazegrid.session import stage


# --- the supervised table -----------------------------------------------------------

def supervised(df: DataFrame, keys, position: Column, features, targets, horizons,
               length: int = chunks.LENGTH) -> DataFrame:
    """Features without gaps and one column `target_hK` per target and horizon.

    Only rows with all targets at all horizons stay. The last max(horizons)
    rows of a series have no lead and go with them.
    """
    whole = clean.fill_with_means(df, features)
    ahead = with_leads(whole, keys, position, targets, horizons, length)
    return ahead.dropna(subset=[lead_name(t, h) for t in targets for h in horizons])


def split_by_time(df: DataFrame, keys, position: Column, test_share: float = catalog.TEST_SHARE,
                  length: int = chunks.LENGTH) -> DataFrame:
    """`split`: the first int(n x (1 - test_share)) rows of a series train, the rest test."""
    cut = F.floor(F.col("n_rows") * F.lit(1 - test_share))
    return chunks.numbered(df, keys, position, length).withColumn(
        "split", F.when(F.col("row_no") < cut, F.lit("train")).otherwise(F.lit("test"))
    ).drop("row_no", "n_rows")


# --- robust scaling -------------------------------------------------------------------

def quartile_table(df: DataFrame, columns) -> DataFrame:
    """(column, center, scale): median and interquartile range, 1 where that is 0."""
    tall = df.select(*columns).unpivot([], list(columns), "column", "v")
    q = exact_quantiles(tall, ["column"], "v", (0.25, 0.5, 0.75), few_groups=True)
    spread = F.col("q")[2] - F.col("q")[0]
    return q.select("column", F.col("q")[1].alias("center"),
                    F.when(spread == 0, F.lit(1.0)).otherwise(spread).alias("scale"))


@dataclass
class RobustScale:
    """Center and scale per column: two numbers for each column of the schema."""

    params: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, df: DataFrame, columns) -> "RobustScale":
        rows = quartile_table(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), columns).collect()
        return cls({r["column"]: (r["center"], r["scale"]) for r in rows})

    def scaled(self, column: str, value: Column | None = None) -> Column:
        center, scale = self.params[column]
        value = F.col(column) if value is None else value
        return (value - F.lit(center)) / F.lit(scale)

    def restored(self, column: str, value: Column) -> Column:
        center, scale = self.params[column]
        return value * F.lit(scale) + F.lit(center)


# --- learners -----------------------------------------------------------------------------

RIDGE_ALPHA, LASSO_ALPHA = linear.RIDGE_ALPHA, linear.LASSO_ALPHA


def learners(trees: int = 200, depth: int = 30, rounds: int = 200, round_depth: int = 10) -> dict[str, Estimator]:
    """The learners that Spark ML has, one model a target."""
    return {
        "RandomForest": RandomForestRegressor(
            numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=42),
        "GradientBoosting": GBTRegressor(
            maxIter=rounds, maxDepth=round_depth, stepSize=0.05, subsamplingRate=0.8,
            featureSubsetStrategy="sqrt", seed=42),
    }


LEARNERS = ("RandomForest", "ExtraTrees", "GradientBoosting", *linear.NAMES)
_MODEL_CLASSES = {"RandomForest": RandomForestRegressionModel, "GradientBoosting": GBTRegressionModel}


@dataclass
class Forecaster:
    """One learner fitted for one horizon: a scale and, unless one forest has all targets, a model per target."""

    horizon: int
    name: str
    features: list[str]
    targets: list[str]
    scale_x: RobustScale
    scale_y: RobustScale
    models: dict[str, Model | linear.Plane] = field(default_factory=dict)
    forest: trees.Forest | None = None

    def predict(self, df: DataFrame, suffix: str = "_pred") -> DataFrame:
        """Add `<target><suffix>` on the original scale."""
        return with_predictions(df, [self], lambda f, target: target + suffix)


def assembled(df: DataFrame, features, scale: RobustScale) -> DataFrame:
    """Add the vector `_x` of scaled features."""
    parts = [f"_x{i}" for i in range(len(features))]
    wide = df.select("*", *[
        scale.scaled(f, F.col(f).cast("double")).alias(p) for f, p in zip(features, parts)])
    return VectorAssembler(inputCols=parts, outputCol="_x").transform(wide).drop(*parts)


def with_predictions(df: DataFrame, forecasters, name: Callable[[Forecaster, str], str]) -> DataFrame:
    """Add the prediction of every forecaster and target under name(forecaster, target), on the original scale.

    Forecasters of one training share features and scale: these are scaled once, and the table is read once for all.
    """
    out, left = df, list(forecasters)
    while left:
        first = left[0]
        group = [f for f in left if f.features == first.features and f.scale_x.params == first.scale_x.params]
        left = [f for f in left if f not in group]
        scaled = [first.scale_x.scaled(c, F.col(c).cast("double")) for c in first.features]
        out = out.withColumn("_a", F.array(*scaled))
        planes = {name(f, t): f.scale_y.restored(t, scoring.height(F.col("_a"), m))
                  for f in group for t, m in f.models.items() if isinstance(m, linear.Plane)}
        out = out.withColumns(planes) if planes else out
        wooded = [f for f in group if f.forest is not None]
        if wooded:
            out = scoring.with_forests(out, "_a", [f.forest for f in wooded], "_packed")
            places = [(f, t) for f in wooded for t in f.targets]
            out = out.withColumns({name(f, t): f.scale_y.restored(t, F.col("_packed")[i]) for i, (f, t) in enumerate(places)}).drop("_packed")
        fitted = [(f, t, m) for f in group for t, m in f.models.items() if not isinstance(m, linear.Plane)]
        if fitted:
            out = assembled(out, first.features, first.scale_x)
            for f, t, model in fitted:
                model.setFeaturesCol("_x").setPredictionCol("_yhat")
                out = model.transform(out).withColumn(name(f, t), f.scale_y.restored(t, F.col("_yhat"))).drop("_yhat")
        out = out.drop("_x", "_a")
    return out


def train(frame: DataFrame, features, targets, horizons, names=LEARNERS, threads: int = 4,
          **sizes) -> dict[tuple[int, str], Forecaster]:
    """Fit every learner for every horizon and target on the rows with split = 'train'.

    The linear learners come from one pass over the rows, for all horizons and targets. Extremely randomised trees
    predict all targets of a horizon at once. Of the others each target is one job of Spark ML, a few side by side.
    """
    labels = [lead_name(t, h) for h in horizons for t in targets]
    # Read several times below, so the windows behind it are evaluated once.
    rows = stage(frame.filter(F.col("split") == "train").select(*dict.fromkeys([*features, *labels])), "train")
    scale = RobustScale.fit(rows, list(features) + labels)
    out = {}
    for h in horizons:
        per_target = RobustScale({t: scale.params[lead_name(t, h)] for t in targets})
        for name in names:
            out[h, name] = Forecaster(h, name, list(features), list(targets), scale, per_target)
    parts = [f"x{i}" for i in range(len(features))]
    scaled = rows.select(*[scale.scaled(f, F.col(f).cast("double")).alias(p) for f, p in zip(features, parts)],
                         *[scale.scaled(y).alias(f"y{i}") for i, y in enumerate(labels)])
    marks = [f"y{i}" for i in range(len(labels))]
    lines = [n for n in names if n in linear.NAMES]
    if lines:
        found = linear.fit(scaled, parts, marks, lines)
        for i, (h, t) in enumerate((h, t) for h in horizons for t in targets):
            for name in lines:
                out[h, name].models[t] = found[name, f"y{i}"]
    if "ExtraTrees" in names:
        ready = stage(scaled.select(F.array(*parts).alias("x"), F.array(*marks).alias("y")), "tree-rows")
        forests = trees.fit(ready, len(parts), len(targets), len(horizons), **{k: v for k, v in sizes.items() if k in ("trees", "depth")})
        for h, forest in zip(horizons, forests):
            out[h, "ExtraTrees"].forest = forest
    jobs = [(h, name, t) for h in horizons for name in names if name in _MODEL_CLASSES for t in targets]
    if jobs:
        ready = assembled(rows, features, scale).select("_x", *[scale.scaled(y).alias(y) for y in labels]).persist()

        def fit(job) -> Model:
            h, name, target = job
            return learners(**sizes)[name].setFeaturesCol("_x").setLabelCol(lead_name(target, h)).setPredictionCol("_yhat").fit(ready)

        with ThreadPoolExecutor(threads) as pool:
            for (h, name, target), model in zip(jobs, pool.map(fit, jobs)):
                out[h, name].models[target] = model
        ready.unpersist()
    return out


def predictions(frame: DataFrame, forecasters) -> DataFrame:
    """Long table (horizon, model, split, target, y, yhat), from one pass over the frame."""
    forecasters = list(forecasters)
    columns = {(f.horizon, f.name, t): f"_p{i}_{k}" for i, f in enumerate(forecasters) for k, t in enumerate(f.targets)}
    wide = with_predictions(frame, forecasters, lambda f, t: columns[f.horizon, f.name, t])
    found = F.array(*[
        F.struct(F.lit(f.horizon).alias("horizon"), F.lit(f.name).alias("model"), F.lit(t).alias("target"),
                 F.col(lead_name(t, f.horizon)).cast("double").alias("y"), F.col(columns[f.horizon, f.name, t]).alias("yhat"))
        for f in forecasters for t in f.targets])
    return wide.select("split", F.inline(found)).select("horizon", "model", "split", "target", "y", "yhat")


# --- scores --------------------------------------------------------------------------------

def metrics(pred: DataFrame, by=("horizon", "model", "target")) -> DataFrame:
    """RMSE, MAE and R2 on both splits, and test errors relative to the test level."""
    def over(split: str, value: Column) -> Column:
        return F.when(F.col("split") == split, value)

    error = F.col("y") - F.col("yhat")
    sums = pred.groupBy(*by).agg(*[
        m.alias(f"{name}_{s}") for s in ("train", "test") for name, m in (
            ("mse", F.avg(over(s, error * error))), ("mae", F.avg(over(s, F.abs(error)))),
            ("var", F.var_pop(over(s, F.col("y")))), ("mean", F.avg(over(s, F.col("y")))))
    ])

    def r2(s: str) -> Column:
        flat = F.when(F.col(f"mse_{s}") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
        return F.when(F.col(f"var_{s}").isNotNull(), F.coalesce(
            F.lit(1.0) - ratio(F.col(f"mse_{s}"), F.col(f"var_{s}")), flat))

    level, std = F.abs("mean_test"), F.sqrt("var_test")
    unit = F.when(level > 1e-6, level).when(std > 1e-6, std).otherwise(F.lit(1.0))
    return sums.select(
        *by,
        *[m.alias(f"{name}_{s}") for s in ("train", "test") for name, m in (
            ("rmse", F.sqrt(f"mse_{s}")), ("mae", F.col(f"mae_{s}")), ("r2", r2(s)))],
        (F.sqrt("mse_test") / unit).alias("normalized_rmse_test"),
        (F.col("mae_test") / unit).alias("normalized_mae_test"),
    )


def weighted_scores(scored: DataFrame, weights: dict[str, float] = catalog.TARGET_WEIGHTS,
                    main: str = "aqi") -> DataFrame:
    """Per horizon and model: weighted R2, weighted relative RMSE, R2 of the main target."""
    w = lookup(F.col("target"), weights, F.lit(1.0))
    return scored.groupBy("horizon", "model").agg(
        (F.sum(w * F.col("r2_test")) / F.sum(w)).alias("overall_r2_test"),
        (F.sum(w * F.col("normalized_rmse_test")) / F.sum(w)).alias("overall_rmse_test"),
        F.coalesce(F.max(F.when(F.col("target") == main, F.col("r2_test"))), F.lit(0.0)).alias("aqi_r2_test"),
    )


def leaderboard(scores: DataFrame, k: int = 2) -> DataFrame:
    """Best k models per horizon; the name decides ties."""
    order = Window.partitionBy("horizon").orderBy(F.desc("overall_r2_test"), "model")
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


# --- keeping models ------------------------------------------------------------------------------

_ABOUT = ("horizon int, rank int, model string, features array<string>, targets array<string>, "
          "scale_x string, scale_y string, planes string")


def save(spark: SparkSession, chosen: dict[tuple[int, int], Forecaster], path: str) -> None:
    """Models and their description below `path`, keyed by (horizon, rank)."""
    about = []
    for (horizon, rank), f in chosen.items():
        folder = f"{path}/horizon_{horizon}/rank_{rank}"
        planes = {t: m for t, m in f.models.items() if isinstance(m, linear.Plane)}
        for target, model in f.models.items():
            if target not in planes:
                model.write().overwrite().save(f"{folder}/{target}")
        if f.forest is not None:
            spark.createDataFrame(f.forest.nodes(), trees.NODES).write.mode("overwrite").parquet(f"{folder}/forest")
        about.append((horizon, rank, f.name, f.features, f.targets,
                      json.dumps(f.scale_x.params), json.dumps(f.scale_y.params), linear.to_json(planes)))
    spark.createDataFrame(about, _ABOUT).coalesce(1).write.mode("overwrite").json(f"{path}/about")


def load(spark: SparkSession, path: str) -> dict[tuple[int, int], Forecaster]:
    out = {}
    for r in spark.read.schema(_ABOUT).json(f"{path}/about").collect():
        def scale(text: str) -> RobustScale:
            return RobustScale({c: tuple(p) for c, p in json.loads(text).items()})
        folder = f"{path}/horizon_{r['horizon']}/rank_{r['rank']}"
        models = linear.from_json(r["planes"])
        if r["model"] in _MODEL_CLASSES:
            models |= {t: _MODEL_CLASSES[r["model"]].load(f"{folder}/{t}") for t in r["targets"]}
        forest = trees.from_nodes(spark.read.parquet(f"{folder}/forest").collect()) if r["model"] == "ExtraTrees" else None
        out[r["horizon"], r["rank"]] = Forecaster(
            r["horizon"], r["model"], r["features"], r["targets"], scale(r["scale_x"]), scale(r["scale_y"]), models, forest)
    return out
