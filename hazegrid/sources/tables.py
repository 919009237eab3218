"""Readers of processed tables and model metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hazegrid import catalog


def daily_schema(columns) -> T.StructType:
    """Types of the processed daily table by column role."""
    def kind(c: str):
        if c == "date":
            return T.DateType()
        if c in catalog.CALENDAR or c == "decade":
            return T.IntegerType()
        return T.StringType() if c in ("aqi_category", "pollution_level", "series", "season_name") else T.DoubleType()
    return T.StructType([T.StructField(c, kind(c)) for c in columns])


def read_daily(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """Processed table: Parquet, or CSV with a header when `columns` gives its layout."""
    if columns is None:
        df = spark.read.parquet(path)
        return df.withColumn("date", F.to_date("date"))
    return spark.read.csv(path, header=True, schema=daily_schema(columns))


def register(spark: SparkSession, **tables: DataFrame) -> None:
    """Make tables known to SQL text by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def read_model_metadata(spark: SparkSession, path: str, documents: bool = True) -> DataFrame:
    """One row per saved model: horizon, rank, name, scores, feature and target lists.

    `documents` says that each file is one JSON document, else one per line.
    """
    score = "struct<overall_r2_test:double,overall_rmse_test:double,aqi_r2_test:double>"
    schema = (
        "horizon int, model_name string, model_idx string, feature_names array<string>, "
        f"targets array<string>, metrics {score}, train_size long, test_size long"
    )
    raw = spark.read.schema(schema).json(
        path, multiLine=documents, recursiveFileLookup=True)
    return raw.filter("model_name IS NOT NULL").select(
        "horizon", "model_idx", "model_name", "feature_names", "targets", "metrics.*", "train_size", "test_size")
