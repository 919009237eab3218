"""Writers of tables, results and metadata."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazegrid.operators import stats


def write_table(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Overwrite a Parquet table or a CSV folder with header."""
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if form == "csv" else writer.parquet(path)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a whole catalog table; the columns of `df` become its columns. Its files lie in a new folder below `path`, or below the
    warehouse.

    The rows are written aside before the table's entry changes, so `df` may read the table itself, and a write that fails leaves
    the table as it was. Files of earlier versions stay, as others may still be reading them.
    """
    spark = df.sparkSession
    place = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}"
    version = f"{place.rstrip('/')}/version-{uuid.uuid4().hex[:12]}"
    df.write.parquet(version)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=version, source="parquet", schema=df.schema)


def as_json(columns: dict[str, Column]) -> Column:
    """One JSON object; missing values are written as null."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in columns.items()]), {"ignoreNullFields": "false"})


def records_json(df: DataFrame, key: str) -> DataFrame:
    """A small result table as one JSON object `{key: {column: value}}`."""
    inner = F.struct(*[F.col(c) for c in df.columns if c != key])
    pairs = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("k"), inner.alias("v"))))
    return df.agg(F.to_json(F.map_from_entries(pairs), {"ignoreNullFields": "false"}).alias("results_json"))


def analysis_row(result: DataFrame, kind: str, summary: Column) -> DataFrame:
    """(analysis_type, analysis_date, results_json, summary) from a one-row result."""
    return result.select(
        F.lit(kind).alias("analysis_type"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("analysis_date"),
        "results_json", summary.alias("summary"))


def append_result(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)


def reload_trends(df: DataFrame, path: str) -> None:
    """Recompute and replace the yearly trends table."""
    stats.yearly_trends(df).coalesce(1).write.mode("overwrite").parquet(path)


def refresh_trends(df: DataFrame, path: str) -> None:
    """Recompute the years that `df` has, in a trends table with a folder for each year; all other years stay.

    Folders are replaced when all rows are written, so a write that fails changes nothing.
    """
    stats.yearly_trends(df).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def dataset_metadata(df: DataFrame, date: str = "date") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.min(date).cast("string").alias("date_min"), F.max(date).cast("string").alias("date_max"))


def write_json(df: DataFrame, path: str) -> None:
    """A small result as one JSON-lines file, nulls included."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
