"""Forecast requests: none is lost, and each unanswered one has its reason."""

import datetime as dt

from hazegrid.operators import forecast
from hazegrid.plans import forecast as job

DAY = dt.date(2001, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def requests(spark, rows):
    return spark.createDataFrame(rows, "station string, forecast_date date")


def test_every_request_comes_back(spark):
    history = spark.createDataFrame([("a", day(n)) for n in (0, 1, 2, 5, 5)] + [("b", day(9))], "station string, date date")
    asked = [("a", day(3)), ("a", day(3)), ("a", day(5)), ("a", day(0)), ("a", day(80)), ("a", None), ("c", day(3)), (None, day(3)), ("b", day(11))]
    out = forecast.plan_requests(requests(spark, asked), history, ["station"])
    found = sorted(((r.station, r.forecast_date, r.base_date, r.horizon, r.recursive, r.unanswered) for r in out.collect()), key=str)
    assert found == sorted([
        ("a", day(3), day(2), 1, False, None), ("a", day(3), day(2), 1, False, None), ("a", day(5), day(4), 1, False, "no data of the base day"),
        ("a", day(0), day(-1), 1, False, "no data of the base day"), ("a", day(80), day(5), 365, False, None), ("a", None, day(5), None, None, "no date"),
        ("c", day(3), None, None, None, "no data"), (None, day(3), None, None, None, "no data"), ("b", day(11), day(9), 1, True, None)], key=str)
    without_keys = forecast.plan_requests(requests(spark, asked).drop("station"), history.limit(0).drop("station"))
    assert {r.unanswered for r in without_keys.collect()} == {"no data", "no date"} and without_keys.count() == len(asked)


class Twice:
    """Forecasts twice the index of the base day."""
    targets, features = ("aqi",), ()

    def predict(self, df, suffix="_pred"):
        return df.withColumn(f"aqi{suffix}", df["aqi"] * 2)


def test_the_job_answers_all_requests(spark):
    daily = spark.createDataFrame([(day(n), 10.0 + n) for n in range(5)], "date date, aqi double")
    asked = spark.createDataFrame([(day(n),) for n in (-3, 2, 6, 9, 300)] + [(None,)], "forecast_date date")
    out = {r.forecast_date: r for r in job.forecasts(asked, daily, {1: Twice(), 7: Twice()}).collect()}
    assert len(out) == 6
    assert [(out[d].predicted, out[d].unanswered) for d in (day(-3), day(2), day(6), day(9), day(300), None)] == [
        (None, "no data of the base day"), (22.0, None), (56.0, None), (28.0, None), (None, "no model of the horizon"), (None, "no date")]
    assert (out[day(2)].actual, out[day(2)].error) == (12.0, 10.0)
