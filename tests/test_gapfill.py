import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazegrid import session
from hazegrid.operators import chunks, gapfill
from tests.util import DAY0, blocks, frame, gappy, policy, result, same


def day():
    return chunks.day(F.col("date"))


RULES = {"g1": (None, 0), "g2": (30, 0), "g2_7": (7, 0), "g3": (0, 2), "both": (30, 2), "roll": (7, 2)}


@pytest.mark.parametrize("length", [16, 100, chunks.LENGTH])
def test_policies_match_pandas_on_random_gaps(spark, length):
    rng = np.random.default_rng(length)
    columns = {}
    for i, make in enumerate((lambda: gappy(rng, 260, 0.3), lambda: blocks(rng, 260), lambda: blocks(rng, 260))):
        values = make()
        for name in RULES:
            columns[f"{name}_{i}"] = values
    rules = {c: gapfill.Fill(*RULES[c.rsplit("_", 1)[0]]) for c in columns}
    out = gapfill.fill_gaps(frame(spark, columns), ["series"], day(), rules, length)
    pdf = out.toPandas().sort_values("date")
    for c, values in columns.items():
        same(pdf[c].astype(float), policy(pd.Series(values), *RULES[c.rsplit("_", 1)[0]]))


@pytest.mark.parametrize("gap", [1, 2, 29, 30, 31, 32, 60, 61, 62, 63, 64, 65])
def test_gap_lengths_around_the_limits(spark, gap):
    values = [1.0, 2.0] + [np.nan] * gap + [50.0, 3.0]
    out = gapfill.fill_gaps(frame(spark, {"v": values}), ["series"], day(), {"v": gapfill.LIMITED}, 16)
    same(result(out, "v"), policy(pd.Series(values), 30, 2))


@pytest.mark.parametrize("values", [[np.nan] * 10, [np.nan] * 4 + [5.0] + [np.nan] * 5, [7.0],
                                    [np.nan] * 45 + [1.0, 2.0] + [np.nan] * 45])
def test_empty_and_single_valued_series(spark, values):
    for rule, (reach, carry) in ((gapfill.LINEAR, (None, 0)), (gapfill.LIMITED, (30, 2)),
                                 (gapfill.forward_backward(2), (0, 2))):
        out = gapfill.fill_gaps(frame(spark, {"v": values}), ["series"], day(), {"v": rule}, 8)
        same(result(out, "v"), policy(pd.Series(values, dtype=float), reach, carry))


def pollutants(s, low, high):
    """The policy step by step on one series."""
    if not s.isna().any():
        return s
    s = policy(s, 30, 2)
    bad = (s < low) | (s > high)
    if bad.any():
        s = policy(s.mask(bad), 30, 2).clip(low, high)
    return s


def test_pollutant_policy_matches_steps(spark):
    rng = np.random.default_rng(5)
    kept = np.full(200, 3.0)
    kept[10] = 900.0                       # out of range but nothing missing: untouched
    wild = blocks(rng, 200)
    wild[::17] = 500.0                     # out of range and with gaps
    calm = gappy(rng, 200, 0.2)            # gaps, nothing out of range
    for name, values, (low, high) in (("a", kept, (0, 20)), ("b", wild, (0, 20)), ("c", calm, (-500, 500))):
        df = frame(spark, {"v": values}, name)
        out = gapfill.fill_pollutants(df, ["series"], day(), {"v": (float(low), float(high))}, length=32)
        same(result(out, "v", name), pollutants(pd.Series(values), low, high))


def weather(s, months):
    pct = s.isna().sum() / len(s) * 100
    if not s.isna().any():
        return s
    if pct < 10:
        return policy(s, None, 2)
    base = months.map(s.groupby(months).mean())
    s = s.interpolate(method="linear", limit_direction="both", limit=30)
    return s.fillna(base)


@pytest.mark.parametrize("share", [0.0, 0.05, 0.6])
def test_weather_policy_matches_steps(spark, share):
    rng = np.random.default_rng(7)
    values = gappy(rng, 400, share)
    if share > 0.5:
        values[100:250] = np.nan
    months = pd.Series(pd.date_range(DAY0, periods=400).month)
    out = gapfill.fill_weather(frame(spark, {"v": values}), ["series"], "date", ["v"], length=64)
    same(result(out, "v"), weather(pd.Series(values), months))


def test_weather_noise_is_repeatable_small_and_only_on_filled_cells(spark):
    rng = np.random.default_rng(8)
    values = gappy(rng, 1100, 0.3)
    values[100:250], values[99], values[250] = np.nan, 40.0, 60.0   # 90 cells out of reach
    df = frame(spark, {"v": values})
    plain = result(gapfill.fill_weather(df, ["series"], "date", ["v"]), "v")
    noisy = result(gapfill.fill_weather(df, ["series"], "date", ["v"], noise=0.05), "v")
    again = result(gapfill.fill_weather(df.repartition(3), ["series"], "date", ["v"], noise=0.05), "v")
    same(noisy, again)
    moved = ~np.isclose(plain, noisy)
    assert moved.sum() == 90 and np.isnan(values[moved]).all()
    assert np.abs(plain - noisy).max() < 6 * 0.05 * np.std(values[~np.isnan(values)])


def test_share_limits_decide_per_series(spark):
    few, many = [1.0, np.nan] + [2.0] * 20, [1.0] + [np.nan] * 12 + [2.0] * 9
    df = frame(spark, {"v": few}, "few").unionByName(frame(spark, {"v": many}, "many"))
    out = gapfill.fill_by_share(df, ["series"], day(), ["v"], gapfill.LINEAR, 10.0, 8)
    same(result(out, "v", "few"), policy(pd.Series(few), None, 0))
    same(result(out, "v", "many"), many)


def test_partitioning_does_not_change_the_result(spark):
    values = blocks(np.random.default_rng(3), 300)
    df = frame(spark, {"v": values})
    one = result(gapfill.fill_gaps(df.repartition(1), ["series"], day(), {"v": gapfill.LIMITED}, 50), "v")
    eight = result(gapfill.fill_gaps(df.repartition(8), ["series"], day(), {"v": gapfill.LIMITED}, 50), "v")
    same(one, eight)


def test_fill_report_counts(spark):
    before = frame(spark, {"v": [1.0, np.nan, np.nan, np.nan, 2.0]})
    after = gapfill.fill_gaps(before, ["series"], day(), {"v": gapfill.Fill(reach=0, carry=1)})
    row = gapfill.fill_report(before, after, ["series"], ["v"]).first()
    assert (row["missing_before"], row["missing_after"], row["filled"]) == (3, 1, 2)


@pytest.mark.parametrize("policy", ["pollutants", "weather", "share"])
def test_cells_move_once_and_never_by_series(spark, policy):
    """Without broadcasts cells are only exchanged to their chunks: once as they are, and once for what a chunk carries on."""
    import re

    rng = np.random.default_rng(2)
    df = session.stage(frame(spark, {"PM2_5": gappy(rng, 60, 0.3), "dew_point": gappy(rng, 60, 0.3)}))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        position = chunks.day(F.col("date"))
        if policy == "pollutants":
            out = gapfill.fill_pollutants(df, ["series"], position, {"PM2_5": (0.0, 40.0)}, session.stage)
        elif policy == "weather":
            out = gapfill.fill_weather(df, ["series"], "date", ["dew_point"])
        else:
            out = gapfill.fill_by_share(df, ["series"], position, ["PM2_5"], gapfill.LINEAR, 50.0)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.split("\n")
    moved = []
    for k, line in enumerate(lines):
        found = re.search(r"Exchange hashpartitioning\(([^)]*)\)", line)
        # What comes below an exchange: cells are what no aggregate or window has made small.
        if found and not re.search("HashAggregate|SortAggregate|ObjectHashAggregate|Window|Join", lines[k + 1]):
            moved.append(found[1])
    assert 1 <= len(moved) <= 2 and all("_chunk" in m for m in moved), moved
