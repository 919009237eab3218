import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazegrid.operators import chunks, windows
from tests.util import blocks, frame, gappy, policy, result, same


def day():
    return chunks.day(F.col("date"))


@pytest.mark.parametrize("length", [5, 16, chunks.LENGTH])
def test_lags_rolling_and_leads_match_pandas(spark, length):
    values = gappy(np.random.default_rng(1), 90, 0.4)
    s, df = pd.Series(values), frame(spark, {"v": values})
    lags = windows.with_lags(df, ["series"], day(), ["v"], (1, 7), length=length)
    rolled = windows.with_rolling(df, ["series"], day(), ["v"], (7, 14), ("mean", "std", "min", "max"), length)
    ahead = windows.with_leads(df, ["series"], day(), ["v"], (1, 7, 30), length)
    for k in (1, 7):
        same(result(lags, f"v_lag{k}"), s.shift(k))
    for n in (7, 14):
        r = s.rolling(n, min_periods=1)
        for stat, expected in (("mean", r.mean()), ("std", r.std()), ("min", r.min()), ("max", r.max())):
            same(result(rolled, f"v_rolling{n}_{stat}"), expected, 1e-6)
    for h in (1, 7, 30):
        same(result(ahead, f"v_h{h}"), s.shift(-h))


def repaired(s, k):
    lag = s.shift(k)
    return lag.fillna(s.shift(-k)).ffill(limit=min(k, 2))


@pytest.mark.parametrize("length", [5, 12, chunks.LENGTH])
def test_features_in_one_pass_match_the_repairs_step_by_step(spark, length):
    values = blocks(np.random.default_rng(2), 120)
    s, df = pd.Series(values), frame(spark, {"v": values})
    out = windows.with_features(df, ["series"], day(), ["v"], length=length)
    lags = windows.with_lags(df, ["series"], day(), ["v"], repair=True, length=length)
    for k in (1, 7):
        same(result(out, f"v_lag{k}"), repaired(s, k))
        same(result(lags, f"v_lag{k}"), repaired(s, k))
    fixed = windows.repair_rolling(out, ["series"], day(), ["v"], length=length)
    for n in (7, 14):
        same(result(fixed, f"v_rolling{n}_mean"), policy(s.rolling(n, min_periods=1).mean(), n, 2), 1e-6)
        same(result(fixed, f"v_rolling{n}_std"), policy(s.rolling(n, min_periods=1).std(), n, 2), 1e-6)


def test_numbering_counts_over_chunks(spark):
    df = frame(spark, {"v": list(range(50))}).filter("date_format(date, 'd') <> '5'")
    out = chunks.numbered(df, ["series"], day(), length=7).orderBy("date").collect()
    assert [r["row_no"] for r in out] == list(range(len(out)))
    assert {r["n_rows"] for r in out} == {len(out)}


def test_halo_copies_stay_few(spark):
    df = frame(spark, {"v": [1.0] * 1000})
    copies = chunks.haloed(df, day(), before=13, after=7, length=500).count()
    assert copies < 1000 + 3 * 20


def test_rolling_band(spark):
    values = gappy(np.random.default_rng(4), 60, 0.0)
    out = windows.rolling_band(frame(spark, {"aqi": values}), ["series"], day())
    r7 = pd.Series(values).rolling(7, min_periods=1)
    same(result(out, "band_low"), r7.mean() - r7.std(), 1e-6)
    same(result(out, "aqi_rolling30_mean"), pd.Series(values).rolling(30, min_periods=1).mean(), 1e-6)
