import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazegrid import catalog
from hazegrid.functions import advice, air, calendar
from hazegrid.functions.numeric import clip, round_even
from hazegrid.operators import clean, index, resample, stats
from hazegrid.operators import quantiles
from hazegrid.operators.quantiles import exact_quantiles
from tests.util import same

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)


@pytest.mark.parametrize("few", [True, False])
def test_exact_quantiles_match_numpy(spark, few):
    rng = np.random.default_rng(11)
    groups = {
        "normal": rng.normal(0, 1, 999), "ties": rng.integers(-3, 3, 500).astype(float), "one": np.array([4.2]),
        "scales": np.array([0.0, -0.0, 5e-324, -1e-300, 1e300, -1e300, 1.0, 2.0, 4.0, 1 - 2 ** -53, 1 + 2 ** -52]),
        "powers": 2.0 ** rng.integers(-40, 40, 300), "near": 1e6 + rng.random(400) * 1e-9,
    }
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("one", None), ("ties", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    out = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", PROBS, few).collect()}
    for k, vs in groups.items():
        assert out[k]["n"] == len(vs)
        same(out[k]["q"], pd.Series(vs).quantile(list(PROBS)), 1e-12)


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("accuracy,margin,most", [(2, 0.0, 1 << 31), (20, None, 1 << 31), (10_000, -0.02, 1 << 31), (10_000, None, 300)])
def test_quantiles_whose_brackets_miss(spark, monkeypatch, few, accuracy, margin, most):
    """A coarse sketch, brackets without room and groups beyond the bound: the digits find what counting doesn't."""
    monkeypatch.setattr(quantiles, "MOST", most)
    used = []
    digits = quantiles.quantiles_by_digits
    monkeypatch.setattr(quantiles, "quantiles_by_digits", lambda *a, **k: used.append(1) or digits(*a, **k))
    rng = np.random.default_rng(12)
    groups = {"normal": rng.normal(0, 1, 4000), "ties": rng.integers(0, 3, 700).astype(float), "same": np.full(350, 2.5), "few": np.array([1.0, 9.0])}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k string, v double").repartition(6)
    out = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", PROBS, few, accuracy, margin).collect()}
    assert used or (accuracy, margin) == (20, None)
    for k, vs in groups.items():
        assert out[k]["n"] == len(vs)
        same(out[k]["q"], pd.Series(vs).quantile(list(PROBS)), 1e-12)


def test_brackets_alone_are_enough_for_large_groups(spark, monkeypatch):
    def digits(*_, **__):
        raise AssertionError("digits were needed")
    monkeypatch.setattr(quantiles, "quantiles_by_digits", digits)
    df = spark.range(300_000).select((F.col("id") % 7).alias("k"), (F.xxhash64("id") / 1e15).alias("v"))
    want = df.toPandas().groupby("k")["v"]
    for r in exact_quantiles(df, ["k"], "v", PROBS, accuracy=1000).collect():
        same(r["q"], want.get_group(r["k"]).quantile(list(PROBS)), 1e-12)


def test_exact_quantiles_without_keys(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert exact_quantiles(df, [], "v", (0.5, 0.25)).first()["q"] == [50.0, 25.0]


def reference_index(c, points):
    if c is None or c < 0:
        return None
    for (a, ia), (b, ib) in zip(points, points[1:]):
        if a <= c <= b:
            return float(round((ib - ia) / (b - a) * (c - a) + ia))
    return 500.0


@pytest.mark.parametrize("component", catalog.COMPONENTS)
def test_sub_index_at_breakpoints_between_and_beyond(spark, component):
    breaks = catalog.BREAKPOINTS[component]
    points = list(zip(breaks, catalog.INDEX_LEVELS))
    values = [None, -1.0, -0.0, breaks[-1] * 2]
    for a, b in zip(breaks, breaks[1:]):
        values += [a, math.nextafter(a, math.inf), math.nextafter(b, -math.inf), b, *np.linspace(a, b, 101).tolist()]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c double")
    got = {r["i"]: r["s"] for r in df.select("i", air.sub_index("c", breaks).alias("s")).collect()}
    assert [got[i] for i in range(len(values))] == [reference_index(v, points) for v in values]


def test_half_indices_round_to_even(spark):
    df = spark.createDataFrame([(0.54,), (2.7,)], "c double")  # 0.5 and 2.5 on the 54 -> 50 segment
    got = [r["s"] for r in df.select(air.sub_index("c", catalog.BREAKPOINTS["PM10"]).alias("s")).collect()]
    assert got == [0.0, 2.0]


def test_overall_index_skips_missing_and_names_the_first_of_ties(spark):
    rows = [(1, 12.0, 54.0, None), (2, None, None, None), (3, None, 54.0, None), (4, -1.0, None, -1.0)]
    df = spark.createDataFrame(rows, "i int, PM2_5 double, PM10 double, SO2_column double")
    got = {r["i"]: r for r in stats.dominant_components(index.with_index(df)).collect()}
    assert (got[1]["aqi"], got[1]["component"], got[1]["aqi_category"]) == (50.0, "PM2_5", "Good")
    assert (got[2]["aqi"], got[2]["component"], got[2]["aqi_category"]) == (None, None, "Unknown")
    assert got[3]["component"] == "PM10"
    # A negative column amount is clipped to zero, a negative PM2.5 has no index.
    assert (got[4]["aqi"], got[4]["component"]) == (0.0, "SO2_column")
    counts = {r["component"]: r["pct"] for r in stats.dominant_counts(index.with_index(df)).collect()}
    assert counts == {"PM2_5": 25.0, "PM10": 25.0, "SO2_column": 25.0}


def test_category_bands(spark):
    values = [None, 0.0, 50.0, 50.1, 100.0, 150.0, 200.0, 300.0, 301.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select(air.category(F.col("v")), air.pollution_level(F.col("v")), air.report_band(F.col("v"))).collect()
    assert [r[0] for r in rows] == ["Unknown", "Good", "Good", "Moderate", "Moderate", "Unhealthy for Sensitive",
                                    "Unhealthy", "Very Unhealthy", "Hazardous"]
    assert [r[1] for r in rows][:4] == ["Unknown", "Low", "Low", "Moderate"] and rows[-1][1] == "Very High"
    assert rows[0][2] == "Very Unhealthy" and rows[-1][2] == "Very Unhealthy"


def test_clip_and_rounding(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (0.125,), (9.0,)], "v double")
    assert [r[0] for r in df.select(clip(F.col("v"), 0.0, 1.0)).collect()] == [None, 0.0, 0.125, 1.0]
    assert df.select(round_even(F.col("v"))).collect()[2][0] == 0.12


def test_season_names_both_ways(spark):
    rows = [("Winter", 7), ("Fall", 1), ("Autumn", 1), ("?", 7), ("2", 1), ("9", 7), (None, 12)]
    df = spark.createDataFrame(rows, "s string, m int")
    got = [r[0] for r in df.select(calendar.season_from_name(F.col("s"), F.col("m"))).collect()]
    assert got == [0, 3, 3, 0, 2, 2, 0]


def test_quantile_bins_merge_equal_edges(spark):
    df = spark.createDataFrame([(float(v), float(i)) for i, v in enumerate([0] * 6 + [1, 2, 3, 4])], "x double, aqi double")
    bins = stats.quantile_bins(df, ["x"], {"m": F.avg("aqi")}).orderBy("bin").collect()
    codes = pd.qcut(pd.Series([0] * 6 + [1, 2, 3, 4]), 5, duplicates="drop")
    assert [r["n"] for r in bins] == codes.value_counts(sort=False).tolist()
    constant = spark.createDataFrame([(1.0, 2.0)] * 3, "x double, aqi double")
    row = stats.quantile_bins(constant, ["x"], {"m": F.avg("aqi")}).collect()
    assert [(r["bin"], r["n"], r["low"], r["high"]) for r in row] == [(1, 3, 1.0, 1.0)]


def test_correlations_delete_missing_pairwise(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(200, 3)), columns=list("abc"))
    pdf["c"] += pdf["a"]
    pdf = pdf.mask(rng.random(pdf.shape) < 0.2)
    df = spark.createDataFrame([tuple(None if pd.isna(x) else float(x) for x in r) for r in pdf.to_numpy()],
                               "a double, b double, c double")
    expected = pdf.corr()
    got = {(r["first"], r["second"]): r["r"] for r in stats.correlation_matrix(df, list("abc")).collect()}
    assert len(got) == 9
    for (a, b), r in got.items():
        assert abs(r - expected.loc[a, b]) < 1e-9


def test_extremes_take_the_lowest_key_on_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0), (4, 1.0), (5, None)], "month int, v double")
    row = stats.extremes(df, "month", "v").first()
    assert (row["worst_month"], row["best_month"]) == (1, 3)


def test_shares_count_unlisted_rows_in_the_total(spark):
    df = spark.createDataFrame([("Good",), ("Good",), ("else",), (None,)], "aqi_category string")
    got = sorted((r["aqi_category"], r["n"], r["pct"]) for r in stats.category_counts(df).collect())
    assert got == [("Good", 2, 50.0), ("else", 1, 25.0)]


def test_daily_sum_is_zero_inside_the_span_only(spark):
    rows = [("a", "2020-01-01 05:00:00", 1.0), ("a", "2020-01-03 05:00:00", None), ("a", "2020-01-05 01:00:00", 2.0)]
    df = spark.createDataFrame(rows, "series string, t string, value double").select(
        "series", F.to_timestamp_ntz("t").alias("ts"), "value")
    days = resample.daily_sum(df, ["series"]).orderBy("date").collect()
    assert [r["value"] for r in days] == [1.0, 0.0, 0.0, 0.0, 2.0]


def test_daily_series_refuses_two_rows_a_day_and_other_hours(spark):
    rows = [("a", "2020-01-01 00:00:00", 1.0), ("a", None, 7.0)]
    df = spark.createDataFrame(rows, "series string, t string, value double").select(
        "series", F.to_timestamp_ntz("t").alias("ts"), "value")
    assert [r["value"] for r in resample.daily_value(df, ["series"]).collect()] == [1.0]
    with pytest.raises(Exception, match="more than one row"):
        resample.daily_value(df.unionByName(df), ["series"]).collect()
    late = df.withColumn("ts", F.expr("ts + interval 6 hours"))
    with pytest.raises(Exception, match="not stamped midnight"):
        resample.daily_value(late, ["series"]).collect()
    table = late.withColumn("feature", F.lit("O3"))
    with pytest.raises(Exception, match="not stamped midnight"):
        resample.to_daily_table(table, ["series"], {"O3": "daily"}, "2020-01-01", "2020-01-03").collect()
    hourly = resample.to_daily_table(table, ["series"], {"O3": "hourly"}, "2020-01-01", "2020-01-02").orderBy("date").collect()
    assert [r["O3"] for r in hourly] == [1.0, None]


def test_sentinels(spark):
    rows = [(1e15, 1e15), (1e15 * 1.004, 1e15), (-999.0, -999.0), (-999.0 + 1e-12, -999.0), (-998.0, -999.0), (3.0, None)]
    df = spark.createDataFrame(rows, "v double, f double")
    got = [r[0] for r in df.select(clean.drop_sentinels(F.col("v"), F.col("f"))).collect()]
    assert got == [None, 1e15 * 1.004, None, None, -998.0, 3.0]


def test_near_sentinels_need_a_share_of_the_rows(spark):
    def swept(n):
        rows = [("s", 1.0, 1e15)] * n + [("s", 1.001e15, 1e15), ("s", 3e15, 1e15)]
        df = spark.createDataFrame(rows, "k string, value double, fill_value double")
        return clean.sweep_near_sentinels(df, ["k"]).filter("value IS NULL").count()
    assert swept(100) == 1 and swept(5000) == 0


def test_recommendation_order(spark):
    df = spark.createDataFrame([(160.0, "2020-11-15", 300.0), (40.0, "2020-07-01", 35.0), (None, "2020-01-02", None)],
                               "aqi double, d string, t double").withColumn("d", F.to_date("d"))
    parts = advice.recommendation(F.col("aqi"), F.col("d"), F.col("t"))
    rows = df.select(*[c.alias(n) for n, c in parts.items()]).collect()
    assert rows[0]["actions"][0] == catalog.ACTION_MASK and "(15/11 - 15/11)" in rows[0]["actions"][-1]
    assert rows[1]["actions"][-1] == catalog.ACTION_HOT and len(rows[1]["actions"]) == 4
    assert rows[2]["title"] == catalog.ADVICE["Moderate"][0] and rows[2]["actions"] == [catalog.ACTION_COLD]


def test_correlations_of_constant_empty_and_single_columns(spark):
    rows = [(1.0, 5.0, None, 2.0), (2.0, 5.0, None, 4.0), (4.0, 5.0, None, None), (None, 5.0, None, 9.0)]
    df = spark.createDataFrame(rows, "a double, flat double, none double, aqi double")
    assert {r["variable"]: r["r"] for r in stats.correlations(df, ["a", "flat", "none"], labelled=True).collect()} == {"a": 1.0, "flat": None, "none": None}
    matrix = {(r["first"], r["second"]): r["r"] for r in stats.correlation_matrix(df, ["a", "flat", "none", "aqi"]).collect()}
    assert len(matrix) == 16
    assert matrix["a", "a"] == matrix["aqi", "aqi"] == 1.0 and matrix["flat", "flat"] is None and matrix["none", "none"] is None
    assert matrix["a", "flat"] is None and matrix["a", "none"] is None
    line = stats.fitted_line(df, "flat", "aqi").first()
    assert line["r"] is None and line["n"] == 3
    assert stats.correlations(df.limit(1), ["a"]).first()["r"] is None


def test_correlation_matches_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1e6, 500)
    y = x * 0.3 + rng.normal(0, 1e6, 500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (1.0, None)], "x double, y double")
    assert abs(df.agg(stats.correlation("x", "y").alias("r")).first()["r"] - np.corrcoef(x, y)[0, 1]) < 1e-12


def test_counts_of_unlisted_names(spark):
    df = spark.createDataFrame([("Good",), ("Other",), (None,), ("Good",)], "aqi_category string")
    assert {r["aqi_category"]: (r["n"], r["pct"]) for r in stats.category_counts(df).collect()} == {"Good": (2, 50.0), "Other": (1, 25.0)}


def test_exact_quantiles_of_numbers_that_are_none_or_infinite(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, nan, None)], "v double")
    assert exact_quantiles(df, [], "v", (0.0, 0.5, 1.0)).first()["q"] == [1.0, 1.5, 2.0]
    wide = spark.createDataFrame([(v,) for v in (-inf, 1.0, 2.0, 3.0, inf)], "v double")
    assert exact_quantiles(wide, [], "v", (0.0, 0.25, 0.5, 0.75, 1.0)).first()["q"] == [-inf, 1.0, 2.0, 3.0, inf]


def test_breakpoints_are_as_published():
    assert catalog.BREAKPOINTS["PM2_5"] == (0.0, 12.0, 35.4, 55.4, 150.4, 250.4, 350.4, 500.4)
    assert catalog.BREAKPOINTS["O3"] == (0.0, 54.0, 70.0, 85.0, 105.0, 200.0, 300.0, 400.0)
    assert catalog.INDEX_LEVELS == (0, 50, 100, 150, 200, 300, 400, 500)
