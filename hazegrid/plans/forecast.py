"""Answer forecast requests with trained models, all at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazegrid.functions import advice
from hazegrid.functions.numeric import clip
from hazegrid.operators import forecast
from hazegrid.operators.learn import Forecaster

#: Days that are forecast one by one, with the model for tomorrow.
STEPS = 3


def forecasts(requests: DataFrame, daily: DataFrame, ranked: dict[int, Forecaster], keys=(),
              value: str = "aqi", temperature: str = "temperature_mean") -> DataFrame:
    """A row for each request (forecast_date); `unanswered` says why one has no forecast.

    `ranked` has the best model of each horizon. Distances of two and three
    days go day by day with the model for one day, all others directly. The
    index is clipped, banded, given its recommendation and compared with what
    is known of the day. `predicted` is missing where no model fits.
    """
    keys = list(keys)
    every = forecast.plan_requests(requests, daily, keys).withColumn("unanswered", F.coalesce(
        "unanswered", F.when(~F.col("horizon").isin(list(ranked)), "no model of the horizon")))
    planned = every.filter("unanswered IS NULL")
    targets = list(dict.fromkeys(t for f in ranked.values() for t in f.targets))
    facts = [*requests.columns, "base_date", "days_ahead", "horizon", "recursive", "unanswered"]
    out = forecast.direct(planned.filter(~F.col("recursive")), daily, ranked, keys).select(
        *facts, *[f"{t}_pred" for t in targets])
    if 1 in ranked:
        one = ranked[1]
        chained = planned.filter("recursive")
        base = daily.join(chained.select(*keys, F.col("base_date").alias("date")).distinct(), [*keys, "date"], "left_semi")
        steps = forecast.recursive(base, one, STEPS, daily, keys)
        known = chained.join(steps, [*keys, "base_date"])

        def at(target: str):
            case = F.lit(None).cast("double")
            for k in range(1, STEPS + 1):
                case = F.when(F.col("days_ahead") == k, F.col(f"{target}_d{k}")).otherwise(case)
            return case

        out = out.unionByName(known.select(*facts, *[
            (at(t) if t in one.targets else F.lit(None).cast("double")).alias(f"{t}_pred") for t in targets]))
    out = out.unionByName(every.filter("unanswered IS NOT NULL").select(
        *facts, *[F.lit(None).cast("double").alias(f"{t}_pred") for t in targets]))
    out = out.withColumn("predicted", clip(F.col(f"{value}_pred"), 0.0, 500.0))
    warmth = F.col(f"{temperature}_pred") if temperature in targets else F.lit(None).cast("double")
    named = out.select("*", *[c.alias(n) for n, c in advice.recommendation(F.col("predicted"), F.col("forecast_date"), warmth).items()])
    return forecast.back_test(named, daily, keys, value)
