"""Summaries of the daily index and its join with daily health facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hazegrid.functions import air
from hazegrid.functions.numeric import round_even
from hazegrid.operators.join import by_day


def totals(index: DataFrame, health: DataFrame) -> DataFrame:
    """Row counts and means of both tables; the second table enters as scalars."""
    other = health.agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.avg("health_index").alias("mean"))).scalar()
    return index.agg(F.count(F.lit(1)).alias("total_aqi_records"), F.avg("aqi").alias("_mean")).select(
        "total_aqi_records", other.getField("n").alias("total_health_records"),
        round_even(F.col("_mean")).alias("avg_aqi"),
        round_even(other.getField("mean")).alias("avg_health_index"))


def recent_years(index: DataFrame, since: int = 2020) -> DataFrame:
    return index.filter(F.col("year") >= since).groupBy("year").agg(
        F.avg("aqi").alias("avg_aqi"), F.max("aqi").alias("max_aqi"), F.min("aqi").alias("min_aqi"),
    ).orderBy(F.desc("year"))


def _health_means(index: DataFrame, health: DataFrame, by: Column, means: dict[str, str]) -> DataFrame:
    facts = by_day(index, health)
    return facts.groupBy(by).agg(
        F.avg("aqi").alias("avg_aqi"), F.count(F.lit(1)).alias("days"),
        *[F.avg(c).alias(name) for name, c in means.items()])


def recent_trends(index: DataFrame, health: DataFrame, since: int = 2020) -> DataFrame:
    recent = index.filter(F.col("year") >= since)
    return _health_means(recent, health.drop("year"), F.col("year"), {"avg_health": "health_index"}).drop(
        "days").orderBy("year")


def seasonal_analysis(index: DataFrame, health: DataFrame) -> DataFrame:
    return _health_means(index, health, F.col("season"), {
        "avg_respiratory": "respiratory_cases", "avg_cardio": "cardiovascular_cases",
        "avg_health": "health_index"}).drop("days").orderBy(F.desc("avg_aqi"))


def pollution_levels(index: DataFrame, health: DataFrame) -> DataFrame:
    return _health_means(index, health, F.col("aqi_category"), {"avg_cases": "total_cases"}).orderBy("avg_aqi")


def health_impact(index: DataFrame, health: DataFrame) -> DataFrame:
    return _health_means(index, health, air.report_band(F.col("aqi")).alias("pollution_level"), {
        "respiratory": "respiratory_cases", "cardiovascular": "cardiovascular_cases",
        "total": "total_cases", "health_index": "health_index"}).orderBy("avg_aqi")
