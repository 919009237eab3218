"""Lag, lead and rolling columns on a complete spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hazegrid.operators import chunks, gapfill

_STATS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def lag_name(column: str, lag: int) -> str:
    return f"{column}_lag{lag}"


def rolling_name(column: str, window: int, stat: str) -> str:
    return f"{column}_rolling{window}_{stat}"


def lead_name(column: str, horizon: int) -> str:
    return f"{column}_h{horizon}"


def with_lags(df: DataFrame, keys, position: Column, columns, lags=(1, 7),
              repair: bool = False, length: int = chunks.LENGTH) -> DataFrame:
    """`c_lagk`: the value k rows back.

    `repair` fills what is missing: first with the value k rows AHEAD, then
    by copying the previous lag value up to min(k, 2) rows. The first step
    uses the future; it is kept because the lag features are defined so.
    """
    far = max(lags)
    wide = chunks.haloed(df, position, before=far + 2, after=far if repair else 0, length=length)
    w = chunks.in_chunk(keys)
    names = [(c, k, lag_name(c, k)) for c in columns for k in lags]

    def lagged(c: str, k: int) -> Column:
        back = F.lag(c, k).over(w)
        return F.coalesce(back, F.lead(c, k).over(w)) if repair else back

    wide = wide.select("*", *[lagged(c, k).alias(name) for c, k, name in names])
    if repair:
        wide = wide.select(*[x for x in wide.columns if x not in {n for _, _, n in names}], *[
            F.last(name, ignorenulls=True).over(w.rowsBetween(-min(k, 2), 0)).alias(name)
            for _, k, name in names
        ])
    return chunks.settled(wide, length)


def with_rolling(df: DataFrame, keys, position: Column, columns, windows=(7, 14),
                 stats=("mean", "std"), length: int = chunks.LENGTH) -> DataFrame:
    """`c_rollingn_stat` over the last n rows including the current one.

    Missing values are skipped; the standard deviation is the sample one and
    missing for a single value.
    """
    wide = chunks.haloed(df, position, before=max(windows) - 1, length=length)
    w = chunks.in_chunk(keys)
    return chunks.settled(wide.select("*", *[
        _STATS[s](c).over(w.rowsBetween(-(n - 1), 0)).alias(rolling_name(c, n, s))
        for c in columns for n in windows for s in stats
    ]), length)


def with_leads(df: DataFrame, keys, position: Column, columns, horizons,
               length: int = chunks.LENGTH) -> DataFrame:
    """`c_hk`: the value k rows ahead."""
    wide = chunks.haloed(df, position, after=max(horizons), length=length)
    w = chunks.in_chunk(keys)
    return chunks.settled(wide.select("*", *[
        F.lead(c, h).over(w).alias(lead_name(c, h)) for c in columns for h in horizons
    ]), length)


def with_features(df: DataFrame, keys, position: Column, columns, lags=(1, 7), windows=(7, 14),
                  stats=("mean", "std"), length: int = chunks.LENGTH) -> DataFrame:
    """Repaired lags and rolling statistics together, in one shuffle."""
    far, broad = max(lags), max(windows)
    wide = chunks.haloed(df, position, before=max(far + 2, broad - 1), after=far, length=length)
    order = f"PARTITION BY {', '.join(f'`{k}`' for k in keys)}, _chunk ORDER BY _pos"
    names = [(c, k, lag_name(c, k)) for c in columns for k in lags]
    rolled = [(c, n, s, rolling_name(c, n, s)) for c in columns for n in windows for s in stats]
    wide = wide.selectExpr(
        "*",
        *[f"coalesce(lag(`{c}`, {k}) OVER ({order}), lead(`{c}`, {k}) OVER ({order})) AS `_{name}`"
          for c, k, name in names],
        *[f"{_STATS[s].__name__}(`{c}`) OVER ({order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS `{name}`"
          for c, n, s, name in rolled],
    )
    wide = wide.selectExpr("*", *[
        f"last(`_{name}`) IGNORE NULLS OVER ({order} ROWS BETWEEN {min(k, 2)} PRECEDING AND CURRENT ROW) AS `{name}`"
        for _, k, name in names
    ])
    out = [*df.columns, *[n for *_, n in names], *[n for *_, n in rolled]]
    return chunks.settled(wide.select("_pos", "_chunk", *out), length)


def repair_rolling(df: DataFrame, keys, position: Column, columns, windows=(7, 14),
                   stats=("mean", "std"), length: int = chunks.LENGTH) -> DataFrame:
    """Fill rolling columns linearly up to one window, then copy min(n, 2) rows."""
    rules = {
        rolling_name(c, n, s): gapfill.Fill(reach=n, carry=min(n, 2))
        for c in columns for n in windows for s in stats
    }
    return gapfill.fill_gaps(df, keys, position, rules, length)


def rolling_band(df: DataFrame, keys, position: Column, column: str = "aqi",
                 length: int = chunks.LENGTH) -> DataFrame:
    """Rolling 7/30 means, rolling 7 deviation and the band of one deviation."""
    out = with_rolling(df, keys, position, [column], (7, 30), ("mean", "std"), length)
    mean, std = F.col(rolling_name(column, 7, "mean")), F.col(rolling_name(column, 7, "std"))
    return out.drop(rolling_name(column, 30, "std")).select(
        "*", (mean - std).alias("band_low"), (mean + std).alias("band_high"))
