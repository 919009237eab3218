"""Small frames and independent pandas/NumPy versions to compare with."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd

DAY0 = dt.date(2001, 1, 1)


def frame(spark, columns: dict, series="a"):
    """Daily frame of one or more value columns (lists with None)."""
    n = len(next(iter(columns.values())))
    rows = [
        (series, DAY0 + dt.timedelta(days=i), *[None if pd.isna(columns[c][i]) else float(columns[c][i]) for c in columns])
        for i in range(n)]
    return spark.createDataFrame(rows, "series string, date date, " + ", ".join(f"`{c}` double" for c in columns))


def result(df, column, series="a"):
    pdf = df.filter(f"series = '{series}'").select("date", column).toPandas().sort_values("date")
    return pdf[column].astype(float).to_numpy()


def gappy(rng, n, share):
    values = rng.normal(50, 20, n)
    values[rng.random(n) < share] = np.nan
    return values


def blocks(rng, n):
    """Long gaps next to short ones, open at both ends."""
    values = rng.normal(10, 3, n)
    at = 0
    while at < n:
        run, gap = int(rng.integers(1, 5)), int(rng.integers(1, 75))
        values[at + run: at + run + gap] = np.nan
        at += run + gap
    if rng.random() < 0.5:
        values[: int(rng.integers(0, 50))] = np.nan
    return values


def same(a, b, tol=1e-9):
    np.testing.assert_allclose(np.asarray(a, float), np.asarray(b, float), rtol=tol, atol=tol, equal_nan=True)


def policy(s, reach, carry):
    if reach != 0:
        s = s.interpolate(method="linear", limit_direction="both", limit=reach)
    return s.ffill(limit=carry).bfill(limit=carry) if carry else s
