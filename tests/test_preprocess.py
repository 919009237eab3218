"""The whole preprocessing against the same steps in pandas, on one station with all kinds of gaps."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hazegrid import catalog
from hazegrid.plans import analysis, preprocess
from tests.test_gapfill import pollutants, weather
from tests.test_stats import reference_index
from tests.test_windows import repaired
from tests.util import policy, same

START, END, N = "2004-10-01", "2005-10-30", 395
RESOLUTIONS = {
    "PM2_5": "hourly", "NO2_trop": "daily", "SO2_column": "daily", "O3": "daily", "CO": "daily",
    "temperature_mean": "daily", "skin_temperature": "daily", "wind_u10m": "hourly", "wind_v10m": "hourly",
    "dew_point": "monthly", "precipitation": "hourly",
}


def raw_series():
    rng = np.random.default_rng(42)
    days = pd.date_range("2004-09-20", "2005-11-05")
    out = {}
    for name, (mean, std) in {"PM2_5": (4e-8, 1.5e-8), "wind_u10m": (0.0, 3.0), "wind_v10m": (1.0, 2.0)}.items():
        hours = pd.date_range(days[0], days[-1], freq="6h")
        out[name] = pd.Series(np.abs(rng.normal(mean, std, len(hours))) if name == "PM2_5"
                              else rng.normal(mean, std, len(hours)), hours)
    out["PM2_5"].iloc[200:204] = np.nan
    out["PM2_5"] = out["PM2_5"].drop(out["PM2_5"].index[400:500])
    out["wind_u10m"].iloc[300:340] = np.nan
    for name, (mean, std) in {"NO2_trop": (4e15, 3e15), "SO2_column": (0.4, 0.35), "O3": (260, 30), "CO": (120, 20),
                              "temperature_mean": (296, 4), "skin_temperature": (297, 4)}.items():
        out[name] = pd.Series(rng.normal(mean, std, len(days)), days)
    out["NO2_trop"] = out["NO2_trop"][rng.random(len(days)) > 0.5]
    out["SO2_column"].iloc[50:130] = np.nan
    out["temperature_mean"].iloc[5:25] = np.nan
    out["skin_temperature"].iloc[100:260] = np.nan
    out["dew_point"] = pd.Series(rng.normal(291, 2, 14), pd.date_range("2004-10-01", periods=14, freq="MS"))
    rain = pd.date_range("2004-10-10", "2005-10-01", freq="8h")
    out["precipitation"] = pd.Series(np.abs(rng.normal(1, 1, len(rain))), rain).drop(rain[90:150])
    return out


def humidity(t, d):
    t, d = t - 273.15, d - 273.15
    return (100 * np.exp(17.27 * d / (d + 237.3)) / np.exp(17.27 * t / (t + 237.3))).clip(0, 100)


def expected(raw):
    spine = pd.date_range(START, END)
    df = pd.DataFrame(index=spine)
    for name, kind in RESOLUTIONS.items():
        s = raw[name][raw[name].index >= START]
        if kind == "hourly":
            r = s.resample("D")
            df[name] = (r.sum() if name == "precipitation" else r.mean()).reindex(spine)
        else:
            df[name] = s.reindex(spine)
            if kind == "monthly":
                df[name] = df[name].interpolate(limit_direction="both")
    df["PM2_5"] *= 1e9
    df["PM10"] = df["PM2_5"] * 1.6
    df["humidity"] = humidity(df["temperature_mean"], df["dew_point"])
    df["wind_speed"] = np.hypot(df["wind_u10m"], df["wind_v10m"])
    df["wind_direction"] = (np.degrees(np.arctan2(df["wind_u10m"], df["wind_v10m"])) + 360) % 360
    before = df.copy()
    for c in catalog.POLLUTANTS:
        if c in df:
            df[c] = pollutants(df[c], *catalog.RANGES[c])
    months = pd.Series(spine.month, spine)
    for c in catalog.WEATHER:
        if c in df:
            df[c] = weather(df[c], months)
    df["PM10"] = df["PM10"].fillna(df["PM2_5"] * 1.6)
    df["humidity"] = df["humidity"].fillna(humidity(df["temperature_mean"], df["dew_point"]))
    df["wind_speed"] = df["wind_speed"].fillna(np.hypot(df["wind_u10m"], df["wind_v10m"]))
    df["wind_direction"] = df["wind_direction"].fillna(
        (np.degrees(np.arctan2(df["wind_u10m"], df["wind_v10m"])) + 360) % 360)
    for c in catalog.DERIVED:
        if 0 < df[c].isna().sum() < len(df) * 0.1:
            df[c] = policy(df[c], None, 2)
    for c in [c for c in catalog.LAGGED if c in df]:
        for k in catalog.LAGS:
            df[f"{c}_lag{k}"] = repaired(df[c], k)
        for n in catalog.ROLLING_WINDOWS:
            r = df[c].rolling(n, min_periods=1)
            for stat, s in (("mean", r.mean()), ("std", r.std())):
                df[f"{c}_rolling{n}_{stat}"] = policy(s, n, 2)
    for c in df:
        if 0 < df[c].isna().sum() < len(df) * 0.5:
            df[c] = policy(df[c], 30, 2)
    scale = {"CO": lambda s: s / 1000, "NO2_trop": lambda s: (s * 2.67e-16).clip(0, 5000),
             "SO2_column": lambda s: (s * 100).clip(0, 5000), "O3": lambda s: (s * 0.2).clip(0, 1000)}
    parts = pd.DataFrame({
        c: [reference_index(None if pd.isna(v) else v, list(zip(catalog.BREAKPOINTS[c], catalog.INDEX_LEVELS)))
            for v in scale.get(c, lambda s: s)(df[c])] for c in catalog.COMPONENTS}).astype(float)
    df["aqi"] = parts.max(axis=1).to_numpy()
    return before, df


def test_preprocessing_matches_the_steps_in_pandas(spark):
    raw = raw_series()
    rows = [("s", f, t.to_pydatetime(), None if pd.isna(v) else float(v)) for f, s in raw.items() for t, v in s.items()]
    tall = spark.createDataFrame(rows, "station string, feature string, ts timestamp_ntz, value double")
    before, after = preprocess.daily_table(tall, ["station"], RESOLUTIONS, START, END, length=64)
    b = before.toPandas().sort_values("date").reset_index(drop=True)
    a = after.toPandas().sort_values("date").reset_index(drop=True)
    eb, ea = expected(raw)
    assert len(a) == N and list(a.columns[:9]) == ["station", *catalog.DAILY_COLUMNS[:8]]
    for c in eb:
        same(b[c].astype(float), eb[c], 1e-7)
    for c in ea:
        same(a[c].astype(float), ea[c], 1e-6)
    assert a["season"].tolist()[:3] == [3, 3, 3] and a["weekday"].tolist()[:3] == [4, 5, 6]
    # The analyses and chart tables run on the result.
    results = {r["analysis_type"]: r["results_json"] for r in analysis.all_results(after).collect()}
    assert set(results) == set(analysis.ANALYSES) and all(results.values())
    made = analysis.charts(after)
    assert len(made) == 14 and made["8_calendar_heatmap"].columns == ["year", *map(str, range(1, 13))]
