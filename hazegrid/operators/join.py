"""Joins of daily facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def to_day(df: DataFrame, ts: str, measures: dict, keys=()) -> DataFrame:
    """Aggregate a fact to one row per day before it is joined."""
    return df.groupBy(*keys, F.col(ts).cast("date").alias("date")).agg(
        *[m.alias(name) for name, m in measures.items()])


def by_day(left: DataFrame, right: DataFrame, keys=()) -> DataFrame:
    """Inner join of two daily facts."""
    return left.join(right, [*keys, "date"])


def on_dates(df: DataFrame, wanted: DataFrame, date: str = "date") -> DataFrame:
    """Rows of the wanted days only (a batch of point lookups)."""
    return df.join(wanted.select(date), date, "left_semi")


def month_baseline(df: DataFrame, keys, value: str, date: str = "date") -> DataFrame:
    """Add the mean of the row's calendar month within its series."""
    means = df.groupBy(*keys, F.month(date).alias("_month")).agg(F.avg(value).alias(f"{value}_month_mean"))
    return df.withColumn("_month", F.month(date)).join(means, [*keys, "_month"], "left").drop("_month")
