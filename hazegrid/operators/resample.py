"""Bring hourly, daily and monthly series onto one daily spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hazegrid.operators import gapfill, chunks


def daily_mean(df: DataFrame, keys, ts: str = "ts", value: str = "value") -> DataFrame:
    """Mean per day over the present values; a day with none of them is missing."""
    return df.groupBy(*keys, F.col(ts).cast("date").alias("date")).agg(F.avg(value).alias(value))


def daily_sum(df: DataFrame, keys, ts: str = "ts", value: str = "value") -> DataFrame:
    """Sum per day; from first to last day of a series a day without values sums to 0."""
    keys = list(keys)
    days = df.groupBy(*keys, F.col(ts).cast("date").alias("date")).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias(value))
    spans = days.groupBy(*keys).agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
    absent = spans.select(*keys, F.explode(F.sequence("_first", "_last")).alias("date"), F.lit(0.0).alias(value))
    return days.unionByName(absent).groupBy(*keys, "date").agg(F.sum(value).alias(value))


def daily_value(df: DataFrame, keys, ts: str = "ts", value: str = "value") -> DataFrame:
    """Values already daily: stamped midnight, and one per day, or the job fails. Rows without a time are left out."""
    at = F.col(ts)
    n = F.count(F.lit(1))
    same = F.when(n == 1, F.first(value)).otherwise(
        F.raise_error(F.lit("a daily series has more than one row for a day")).cast("double"))
    return df.filter(at.isNotNull()).groupBy(*keys, day_of(at).alias("date")).agg(same.alias(value))


def day_of(at: Column, daily: Column | None = None) -> Column:
    """The day of a time; a time of a daily series must be midnight, or the job fails."""
    off = at != F.date_trunc("day", at)
    wrong = off if daily is None else daily & off
    return F.when(wrong, F.raise_error(F.lit("a daily series has a row that is not stamped midnight")).cast("date")).otherwise(at.cast("date"))


def spine(df: DataFrame, keys, start, end, step: str = "1 day", name: str = "date") -> DataFrame:
    """Every step from `start` to `end` for every series in `df`."""
    kind = "date" if step.endswith("day") else "timestamp_ntz"
    steps = F.sequence(F.lit(start).cast(kind), F.lit(end).cast(kind), F.expr(f"interval {step}"))
    return df.select(*keys).distinct().select("*", F.explode(steps).alias(name))


def on_spine(df: DataFrame, keys, start, end, values=("value",), step: str = "1 day",
             name: str = "date") -> DataFrame:
    """Left join of already resampled series on their spine."""
    steps = spine(df, keys, start, end, step, name)
    return steps.join(df.select(*keys, name, *values), [*keys, name], "left")


def monthly_to_daily(df: DataFrame, keys, start, end, value: str = "value", ts: str = "ts") -> DataFrame:
    """Month values on the daily spine, straight lines between, ends held flat."""
    placed = on_spine(daily_value(df, keys, ts, value), keys, start, end, (value,))
    return gapfill.fill_gaps(placed, keys, chunks.day(F.col("date")), {value: gapfill.LINEAR})


def to_daily_table(raw: DataFrame, keys, resolutions: dict[str, str], start, end,
                   ts: str = "ts", feature: str = "feature", value: str = "value") -> DataFrame:
    """Long series of any cadence to one wide row per series and day.

    The spine is added as empty rows, so that resampling, the join of all
    features and the completion of missing days are ONE aggregation with
    map-side combine. Monthly columns are left to be interpolated.
    """
    keys = list(keys)
    at = F.col(ts)
    daily = [f for f, r in resolutions.items() if r != "hourly"]
    kept = raw.filter(
        (at >= F.lit(start).cast("timestamp_ntz"))
        & (at < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    ).select(*keys, day_of(at, F.col(feature).isin(daily)).alias("date"), feature, value)
    empty = spine(raw, keys, start, end).select(
        *keys, "date", F.lit(None).cast("string").alias(feature), F.lit(None).cast("double").alias(value))

    def cell(name: str, resolution: str) -> list[Column]:
        mine = F.when(F.col(feature) == name, F.col(value))
        if name == "precipitation" and resolution == "hourly":
            return [F.sum(mine).alias(name)]
        if resolution == "hourly":
            return [F.avg(mine).alias(name)]
        # The mean of one value is that value; more than one is an error.
        one = F.when(F.count_if(F.col(feature) == name) <= 1, F.avg(mine)).otherwise(
            F.raise_error(F.lit(f"{name} has more than one row for a day")).cast("double"))
        return [one.alias(name)]

    rows = kept.unionByName(empty)
    if resolutions.get("precipitation") == "hourly":
        # Days without rain values inside the span of the series count as dry: a zero more on each of them.
        rain = kept.filter(F.col(feature) == "precipitation").groupBy(*keys).agg(
            F.min("date").alias("_first"), F.max("date").alias("_last"))
        rows = rows.unionByName(rain.select(
            *keys, F.explode(F.sequence("_first", "_last")).alias("date"),
            F.lit("precipitation").alias(feature), F.lit(0.0).alias(value)))
    return rows.groupBy(*keys, "date").agg(
        *[c for name, resolution in resolutions.items() for c in cell(name, resolution)])
