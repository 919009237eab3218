"""Raw series to the processed daily table.

Each stage is one or two shuffles over (series, chunk of days) and ends in a
written table, so a stage reads files and not the history of all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazegrid import catalog
from hazegrid.functions import air, weather
from hazegrid.functions.calendar import calendar_fields
from hazegrid.operators import chunks, clean, gapfill, resample, sinks, windows
from hazegrid.operators.index import with_index
from hazegrid.session import stage
from hazegrid.sources import series_files


def with_gaps(df: DataFrame, columns) -> list[str]:
    """Columns with any missing value: one aggregate, one row of flags."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return []
    flags = df.agg(*[F.expr(f"bool_or(`{c}` IS NULL) AS `{c}`") for c in columns]).first()
    return [c for c in columns if flags[c]]


def derive(df: DataFrame) -> DataFrame:
    """Units, derived weather and particle columns, calendar fields."""
    out = df
    if "PM2_5" in df.columns:
        out = out.withColumn("PM2_5", air.micrograms(F.col("PM2_5")))
        out = out.withColumn("PM10", air.coarse_from_fine(F.col("PM2_5")))
    found: dict = {}
    if {"temperature_mean", "dew_point"} <= set(df.columns):
        found["humidity"] = weather.relative_humidity(F.col("temperature_mean"), F.col("dew_point"))
    if {"wind_u10m", "wind_v10m"} <= set(df.columns):
        found["wind_speed"] = weather.wind_speed(F.col("wind_u10m"), F.col("wind_v10m"))
        found["wind_direction"] = weather.wind_direction(F.col("wind_u10m"), F.col("wind_v10m"))
    return out.withColumns({**found, **calendar_fields(F.col("date"))})


def recompute(df: DataFrame) -> DataFrame:
    """Derived columns where they are missing and their sources are not."""
    again: dict = {}
    if {"PM10", "PM2_5"} <= set(df.columns):
        again["PM10"] = air.coarse_from_fine(F.col("PM2_5"))
    if {"humidity", "temperature_mean", "dew_point"} <= set(df.columns):
        again["humidity"] = weather.relative_humidity(F.col("temperature_mean"), F.col("dew_point"))
    if {"wind_u10m", "wind_v10m"} <= set(df.columns):
        again["wind_speed"] = weather.wind_speed(F.col("wind_u10m"), F.col("wind_v10m"))
        again["wind_direction"] = weather.wind_direction(F.col("wind_u10m"), F.col("wind_v10m"))
    return df.withColumns({c: F.coalesce(F.col(c), x) for c, x in again.items() if c in df.columns})


def fill_missing(df: DataFrame, keys, noise: float = 0.0, length: int = chunks.LENGTH) -> DataFrame:
    """All policies in order: pollutants, weather, derived columns."""
    position = chunks.day(F.col("date"))
    dirty = with_gaps(df, catalog.POLLUTANTS)
    if dirty:
        df = stage(gapfill.fill_pollutants(
            df, keys, position, {c: catalog.RANGES[c] for c in dirty}, stage, length), "pollutants")
    dirty = with_gaps(df, catalog.WEATHER)
    if dirty:
        df = stage(gapfill.fill_weather(df, keys, "date", dirty, noise, length=length), "weather")
    df = recompute(df)
    dirty = with_gaps(df, catalog.DERIVED)
    return stage(gapfill.fill_by_share(df, keys, position, dirty, gapfill.LINEAR, 10.0, length), "derived")


def featured(df: DataFrame, keys, length: int = chunks.LENGTH) -> DataFrame:
    """Lag and rolling columns with their repairs, then the last sweep over all measures."""
    position = chunks.day(F.col("date"))
    lagged = [c for c in catalog.LAGGED if c in df.columns]
    df = stage(windows.with_features(
        df, keys, position, lagged, catalog.LAGS, catalog.ROLLING_WINDOWS, catalog.ROLLING_STATS, length), "features")
    rolling = {
        windows.rolling_name(c, n, s): gapfill.Fill(reach=n, carry=min(n, 2))
        for c in lagged for n in catalog.ROLLING_WINDOWS for s in catalog.ROLLING_STATS}
    dirty = with_gaps(df, rolling)
    if dirty:
        df = stage(gapfill.fill_gaps(df, keys, position, {c: rolling[c] for c in dirty}, length), "rolling")
    measures = [c for c, t in df.dtypes if t == "double"]
    dirty = with_gaps(df, measures)
    return gapfill.fill_by_share(df, keys, position, dirty, gapfill.LIMITED, 50.0, length)


def before_fill(raw: DataFrame, keys, resolutions: dict[str, str], start=catalog.START_DATE,
                end=catalog.END_DATE, length: int = chunks.LENGTH) -> DataFrame:
    """The daily table before gaps are filled."""
    # The gap filling reads it twice.
    wide = stage(resample.to_daily_table(raw, keys, resolutions, start, end), "wide")
    monthly = {f: gapfill.LINEAR for f, r in resolutions.items() if r == "monthly"}
    placed = gapfill.fill_gaps(wide, keys, chunks.day(F.col("date")), monthly, length)
    return derive(placed)


def daily_table(raw: DataFrame, keys, resolutions: dict[str, str], start=catalog.START_DATE,
                end=catalog.END_DATE, noise: float = 0.0, length: int = chunks.LENGTH) -> tuple[DataFrame, DataFrame]:
    """(before filling, finished) daily tables of long cleaned series (keys, feature, ts, value)."""
    keys = list(keys)
    before = stage(before_fill(raw, keys, resolutions, start, end, length), "before_fill")
    filled = fill_missing(before, keys, noise, length)
    ordered = filled.select(*keys, *[
        c for c in clean.in_order(filled.columns, catalog.DAILY_COLUMNS) if c not in keys])
    return before, with_index(featured(ordered, keys, length))


def preprocess(spark: SparkSession, path: str, start=catalog.START_DATE, end=catalog.END_DATE,
               noise: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Daily tables of all series files below `path`, as one station."""
    # A feature without a row since the start has no column.
    series = stage(clean.from_date(series_files.read_clean_series(spark, path), "ts", start), "series")
    # One row per feature of the catalog.
    cadence = {r["feature"]: r["resolution"] for r in series_files.cadence(series).collect()}
    raw = series.withColumn("station", F.lit("all"))
    return daily_table(raw, ["station"], cadence, start, end, noise)


def save(before: DataFrame, done: DataFrame, folder: str) -> None:
    """Both checkpoints: the table before its gaps are filled as CSV, the finished one as Parquet."""
    sinks.write_table(before, f"{folder}/before_fill", "csv")
    sinks.write_table(done, f"{folder}/daily")
