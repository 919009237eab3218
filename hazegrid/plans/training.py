"""Train, compare and keep forecasting models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazegrid import catalog
from hazegrid.operators import chunks, clean, learn, sinks
from hazegrid.session import stage


def prepared(daily: DataFrame, keys, targets=catalog.TARGETS, horizons=catalog.HORIZONS,
             features=None, length: int = chunks.LENGTH) -> tuple[DataFrame, list[str], list[str]]:
    """(supervised rows with their split, features, targets present)."""
    targets = [t for t in targets if t in daily.columns]
    numeric = [c for c, t in daily.dtypes if t in ("double", "int", "bigint")]
    features = features or [c for c in clean.feature_columns(numeric, targets) if c not in keys]
    # A feature without any value cannot be filled.
    found = daily.agg(*[F.count(c).alias(c) for c in features]).first()
    features = [c for c in features if found[c]]
    day = chunks.day(F.col("date"))
    rows = learn.supervised(daily, keys, day, features, targets, horizons, length)
    return learn.split_by_time(rows, keys, day, length=length), list(features), targets


def train_and_rank(frame: DataFrame, features, targets, horizons=catalog.HORIZONS, names=learn.LEARNERS,
                   threads: int = 4, k: int = 2, **sizes):
    """(forecasters, metrics per target, leaderboard).

    The rows are written first: training and every model's predictions read them.
    """
    frame = stage(frame, "supervised")
    fitted = learn.train(frame, features, targets, horizons, names, threads, **sizes)
    scored = stage(learn.metrics(learn.predictions(frame, fitted.values())), "scored")
    board = learn.leaderboard(learn.weighted_scores(scored), k)
    return fitted, scored, board


def keep_best(spark: SparkSession, fitted, board: DataFrame, path: str) -> dict:
    """Save the ranked models of each horizon and return them."""
    chosen = {(r["horizon"], r["rank"]): fitted[r["horizon"], r["model"]] for r in board.collect()}
    learn.save(spark, chosen, path)
    return chosen


def metadata(board: DataFrame, features, targets, sizes: DataFrame) -> DataFrame:
    """One row per kept model, in the layout `read_model_metadata` reads."""
    facts = sizes.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    n = facts.agg(F.struct(
        F.max(F.when(F.col("split") == "train", F.col("n"))).alias("train"),
        F.max(F.when(F.col("split") == "test", F.col("n"))).alias("test"))).scalar()
    return board.select(
        "horizon", F.col("model").alias("model_name"), F.concat(F.lit("model"), "rank").alias("model_idx"),
        F.array(*[F.lit(f) for f in features]).alias("feature_names"),
        F.array(*[F.lit(t) for t in targets]).alias("targets"),
        F.struct("overall_r2_test", "overall_rmse_test", "aqi_r2_test").alias("metrics"),
        n.getField("train").alias("train_size"), n.getField("test").alias("test_size"))


def run(daily: DataFrame, keys, folder: str, horizons=catalog.HORIZONS, names=learn.LEARNERS, **sizes) -> dict:
    """The whole training job: models under `folder`/models, their descriptions under `folder`/metadata."""
    frame, features, targets = prepared(daily, keys, horizons=horizons)
    frame = stage(frame, "supervised")
    fitted, _, board = train_and_rank(frame, features, targets, horizons, names, **sizes)
    board = stage(board, "board")
    sinks.write_json(metadata(board, features, targets, frame), f"{folder}/metadata")
    return keep_best(daily.sparkSession, fitted, board, f"{folder}/models")
