"""Text series with a metadata header.

A file has metadata lines, one header line `time, <variable>` and data lines
`2000-01-01 00:00:00,290.09`. Lines are told apart by their shape and not by
their number, so large files can be split and a "file" may also be a folder
`<name>.csv/` of parts. Nothing is parsed on the driver.

A file is known by its whole path: files of one name in two folders are two
files. A feature may come in any number of files, each with its own fill
value; where they overlap, the first file by name counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hazegrid import catalog
from hazegrid.operators import clean
from hazegrid.session import stage

# A folder of parts may be written as `<column>=<name>.csv`.
_PATH = r"^(.*\.csv)(?:/[^/]*)?$"
_NAME = r"([^/=]*\.csv)$"


def _path_of(path: Column) -> Column:
    return F.regexp_extract(path, _PATH, 1)


def _name_of(path: Column) -> Column:
    return F.regexp_extract(path, _NAME, 1)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, value) of all text below `path`."""
    text = spark.read.option("recursiveFileLookup", "true").text(path)
    # Paths of this column arrive percent-encoded.
    return text.select(_path_of(F.url_decode(F.col("_metadata.file_path"))).alias("path"), "value")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path) of the files below `path`; without its content column this source opens no file."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select(_path_of(F.col("path")).alias("path")).distinct()


def _feature_of(file: Column) -> Column:
    case = F.lit(None).cast("string")
    for token, (feature, _) in reversed(list(catalog.SERIES.items())):
        case = F.when(file.startswith(f"g4.areaAvgTimeSeries.{token}"), F.lit(feature)).otherwise(case)
    rain = F.lit(False)
    for token in catalog.PRECIPITATION_TOKENS:
        rain = rain | file.contains(token)
    return F.when(case.isNull() & rain, F.lit("precipitation")).otherwise(case)


def known_files(files: DataFrame) -> DataFrame:
    """(path, file, feature) of all files (path) whose name tells a known feature."""
    named = files.select("path", _name_of(F.col("path")).alias("file"))
    return named.withColumn("feature", _feature_of(F.col("file"))).filter("feature IS NOT NULL")


def parse(lines: DataFrame) -> DataFrame:
    """(path, ts, value, fill_value) of the lines that say something.

    A data line has a time and its first value, a `Fill Value` line its last
    field. Text that isn't a finite number is a missing value.
    """
    parts = F.split("value", ",")
    is_data = F.col("value").rlike(r"^\d{4}-")
    is_fill = F.col("value").contains("Fill Value") & ~is_data

    def number(text: Column) -> Column:
        v = F.trim(text).try_cast("double")
        return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)

    return lines.filter(is_data | is_fill).select(
        "path",
        F.when(is_data, F.to_timestamp_ntz(F.trim(parts[0]))).alias("ts"),
        F.when(is_data, number(F.try_element_at(parts, F.lit(2)))).alias("value"),
        F.when(is_fill, number(F.element_at(parts, -1))).alias("fill_value"),
        is_data.alias("is_data"),
    )


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """All known series below `path`: (feature, ts, value, fill_value), as declared.

    The text is parsed once and written; fill values and data are read from
    there. Every file's facts are one row, joined by size as it turns out.
    """
    parsed = stage(parse(read_lines(spark, path)), "lines")
    fills = parsed.filter("NOT is_data").groupBy("path").agg(F.max("fill_value").alias("fill_value"))
    facts = known_files(parsed.select("path").distinct()).join(fills, "path", "left")
    rows = parsed.filter("is_data").select("path", "ts", "value").join(facts, "path")
    # One time of one feature has a row or few in each file that has it.
    place = F.struct("file", "path")
    first = F.min(place).over(Window.partitionBy("feature", "ts"))
    return rows.withColumn("_first", first == place).filter("_first").select("feature", "ts", "value", "fill_value")


def read_clean_series(spark: SparkSession, path: str) -> DataFrame:
    """(feature, ts, value) with declared and near-declared fill values blanked."""
    raw = stage(read_series(spark, path), "raw")
    exact = raw.withColumn("value", clean.drop_sentinels(F.col("value"), F.col("fill_value")))
    return clean.sweep_near_sentinels(exact, ["feature"], few_groups=True).select("feature", "ts", "value")


def cadence(series: DataFrame) -> DataFrame:
    """(feature, n_rows, resolution); rain is hourly if any of its stamps is off midnight, else daily."""
    known = F.lit("daily")
    for feature, resolution in catalog.RESOLUTION.items():
        known = F.when(F.col("feature") == feature, F.lit(resolution)).otherwise(known)
    within = F.bool_or(F.col("ts") != F.date_trunc("day", "ts"))
    return series.groupBy("feature").agg(F.count(F.lit(1)).alias("n_rows"), within.alias("_within")).select(
        "feature", "n_rows",
        F.when((F.col("feature") == "precipitation") & F.col("_within"), F.lit("hourly")).otherwise(known).alias("resolution"),
    )
