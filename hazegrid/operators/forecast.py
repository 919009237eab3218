"""Forecast requests: base day, horizon, direct and recursive forecasts, back-test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hazegrid import catalog
from hazegrid.functions.calendar import calendar_fields
from hazegrid.functions.numeric import clip, percent
from hazegrid.operators.learn import Forecaster


def choose_horizon(days: Column) -> dict[str, Column]:
    """Model horizon for a distance in days, and whether to go day by day."""
    horizon = (
        F.when(days <= 3, F.lit(1)).when(days <= 14, F.lit(7))
        .when(days <= 60, F.lit(30)).when(days.isNotNull(), F.lit(365))
    )
    return {"horizon": horizon, "recursive": days.between(2, 3)}


def choose_base(forecast: Column, last: Column) -> dict[str, Column]:
    """Base day of a request, given the last day with data, and the distance to it.

    A day inside the data is forecast from the day before. Late 2025 has a
    fixed base once the data reach it.
    """
    fixed = F.lit(catalog.FIXED_BASE).cast("date")
    late = forecast.between(fixed, F.lit(catalog.FIXED_BASE_LAST).cast("date"))
    base = (
        F.when(forecast <= last, F.date_sub(forecast, 1))
        .when(late & (fixed <= last), fixed).otherwise(last)
    )
    return {"base_date": base, "days_ahead": F.datediff(forecast, base)}


def plan_requests(requests: DataFrame, history: DataFrame, keys=()) -> DataFrame:
    """All requests (forecast_date) with base day, distance and horizon.

    `unanswered` says why a request can't be forecast: it has no date, its series has no data, or its base day has none. It is
    missing for all others, which a forecast goes on with.
    """
    keys = list(keys)
    if keys:
        with_last = requests.join(history.groupBy(*keys).agg(F.max("date").alias("_last")), keys, "left")
    else:
        with_last = requests.withColumn("_last", history.agg(F.max("date")).scalar())
    based = with_last.select(
        *requests.columns, *[c.alias(n) for n, c in choose_base(F.col("forecast_date"), F.col("_last")).items()])
    known = history.select(*keys, F.col("date").alias("base_date")).distinct().withColumn("_known", F.lit(True))
    reason = F.when(F.col("forecast_date").isNull(), "no date").when(F.col("base_date").isNull(), "no data") \
        .when(F.col("_known").isNull(), "no data of the base day")
    return based.join(known, [*keys, "base_date"], "left").select(
        *based.columns, *[c.alias(n) for n, c in choose_horizon(F.col("days_ahead")).items()], reason.alias("unanswered"))


def bounded_index(df: DataFrame, column: str = "aqi_pred") -> DataFrame:
    return df.withColumn(column, clip(F.col(column), 0.0, 500.0)) if column in df.columns else df


def fill_features(df: DataFrame, features, base: dict[str, Column] | None = None) -> DataFrame:
    """Missing features: value of the base row, else the column mean, else 0."""
    base = base or {}
    means = df.agg(F.struct(*[F.avg(f).alias(f) for f in features])).scalar()
    return df.select(*[
        F.coalesce(F.col(c), *([base[c]] if c in base else []), means.getField(c), F.lit(0)).alias(c)
        if c in features else F.col(c) for c in df.columns])


def direct(requests: DataFrame, history: DataFrame, forecasters: dict[int, Forecaster], keys=()) -> DataFrame:
    """Forecast each request from its base row with the model of its horizon.

    No request is lost: one whose horizon has no model, or whose base row is
    missing, comes back without predictions.
    """
    keys = list(keys)
    targets = list(dict.fromkeys(t for f in forecasters.values() for t in f.targets))
    empty = [F.lit(None).cast("double").alias(f"{t}_pred") for t in targets]
    rows = history.withColumnRenamed("date", "base_date").withColumn("_known", F.lit(True))
    out = requests.filter(~F.coalesce(F.col("horizon").isin(list(forecasters)), F.lit(False))).select(*requests.columns, *empty)
    for horizon, f in forecasters.items():
        mine = requests.filter(F.col("horizon") == horizon).join(rows, [*keys, "base_date"], "left")
        part = bounded_index(f.predict(mine.filter("_known"))).select(
            *requests.columns, *[F.col(f"{t}_pred") if t in f.targets else F.lit(None).cast("double").alias(f"{t}_pred") for t in targets])
        out = out.unionByName(part).unionByName(mine.filter("_known IS NULL").select(*requests.columns, *empty))
    return out


def recursive(base: DataFrame, forecaster: Forecaster, steps: int, history: DataFrame | None = None,
              keys=(), date: str = "date") -> DataFrame:
    """Day-by-day forecasts for ALL base rows at once.

    Each step predicts every target one day ahead, moves the row to that day
    and rebuilds its calendar, lag and rolling features from the predictions
    made so far; other features keep their base value. The state is columns,
    so a step is a projection and moves no data. Returns one row per base row
    with `<target>_d<k>` for k = 1..steps.

    `history` (keys, date, targets) supplies the value seven days back for the
    single step where the predictions do not yet reach that far.
    """
    keys = list(keys)
    f = forecaster
    state = base.withColumn("_base_date", F.col(date))
    for step in range(1, steps + 1):
        state = bounded_index(f.predict(state, "_now"), "aqi_now")
        state = state.withColumn("_next", F.date_add(date, 1))
        if step == 6 and history is not None and any(f"{t}_lag7" in f.features for t in f.targets):
            past = history.select(*keys, F.date_add("date", 7).alias("_next"),
                                  *[F.col(t).alias(f"{t}_past") for t in f.targets])
            state = state.join(past, [*keys, "_next"], "left")
        moved: dict[str, Column] = {date: F.col("_next")}
        moved.update({n: c for n, c in calendar_fields(F.col("_next")).items() if n in state.columns})
        for t in f.targets:
            now = F.col(f"{t}_now")
            seen = [F.col(f"{t}_d{k}") for k in range(1, step)] + [now]
            moved[t] = now
            if f"{t}_lag1" in f.features:
                moved[f"{t}_lag1"] = now
            if f"{t}_lag7" in f.features:
                if step >= 7:
                    moved[f"{t}_lag7"] = seen[-7]
                elif f"{t}_past" in state.columns:
                    moved[f"{t}_lag7"] = F.coalesce(F.col(f"{t}_past"), F.col(f"{t}_lag7"))
            for n in catalog.ROLLING_WINDOWS:
                last = seen[-n:]
                mean = sum(last[1:], last[0]) / F.lit(float(len(last)))
                if f"{t}_rolling{n}_mean" in f.features:
                    moved[f"{t}_rolling{n}_mean"] = mean
                if f"{t}_rolling{n}_std" in f.features:
                    off = [(x - mean) * (x - mean) for x in last]
                    moved[f"{t}_rolling{n}_std"] = F.sqrt(sum(off[1:], off[0]) / F.lit(float(len(last))))
        state = state.select(
            *[moved.get(c, F.col(c)).alias(c) for c in state.columns
              if c != "_next" and not c.endswith("_now") and not c.endswith("_past")],
            *[F.col(f"{t}_now").alias(f"{t}_d{step}") for t in f.targets])
    return state.select(
        *keys, F.col("_base_date").alias("base_date"),
        *[f"{t}_d{k}" for k in range(1, steps + 1) for t in f.targets])


def back_test(forecasts: DataFrame, actuals: DataFrame, keys=(), value: str = "aqi") -> DataFrame:
    """Absolute and percentage error where the forecast day has an actual value."""
    known = actuals.select(*keys, F.col("date").alias("forecast_date"), F.col(value).alias("actual"))
    joined = forecasts.join(known, [*keys, "forecast_date"], "left")
    error = F.abs(F.col("predicted") - F.col("actual"))
    return joined.select("*", error.alias("error"), percent(error, F.col("actual")).alias("error_pct"))
