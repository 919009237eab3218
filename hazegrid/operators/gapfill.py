"""Gap filling on a complete spine.

Every missing cell is filled from its two neighbours: the nearest present
value before and after it. With those four numbers per cell the policies are
plain column expressions, including a linear fill limited to some distance
followed by copying the last filled value a little further.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from hazegrid.functions.numeric import clip
from hazegrid.operators import chunks


@dataclass(frozen=True)
class Fill:
    """How far a column is filled.

    reach     a cell is interpolated when at most this many rows from a present
              value on either side; None is no limit, 0 no interpolation. The
              slope always spans the whole gap. May be a SQL expression.
    carry     afterwards a still missing cell takes the last filled value at
              most this many rows back,
    backward  or else the next one at most this many rows ahead.
    """

    reach: int | str | None = None
    carry: int = 0
    backward: bool = True


LINEAR = Fill()
LIMITED = Fill(reach=30, carry=2)


def forward_backward(k: int) -> Fill:
    return Fill(reach=0, carry=k)


def neighbours(df: DataFrame, keys, position: Column, columns, length: int = chunks.LENGTH,
               known: DataFrame | None = None) -> DataFrame:
    """Add position and value of the nearest present cell on both sides.

    For column c: `c__pp`, `c__pv` (at or before the row) and `c__np`, `c__nv`
    (at or after it); `_pos` is the row's own position. One small row per
    chunk is ordered over the whole series, the cells only inside chunks.
    `known` has one row per series; its columns travel with the chunk rows, so
    that the cells themselves move once, to their chunk, and never by series.

    Wide tables need hundreds of expressions here, so they are given as SQL
    text: one call each instead of one per operator.
    """
    keys, columns = list(keys), list(columns)
    df = df.withColumn("_pos", position).withColumn("_chunk", chunks.chunk_of(F.col("_pos"), length))
    series = ", ".join(f"`{k}`" for k in keys)

    def over(partition: str, order: str, last: str) -> str:
        return f"OVER (PARTITION BY {partition} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND {last})"

    def at(c: str) -> str:
        return f"CASE WHEN `{c}` IS NOT NULL THEN _pos END"

    ends = df.groupBy(*keys, "_chunk").agg(*[
        F.expr(edge) for c in columns for edge in (
            f"min({at(c)}) AS `{c}__fp`", f"min_by(`{c}`, {at(c)}) AS `{c}__fv`",
            f"max({at(c)}) AS `{c}__lp`", f"max_by(`{c}`, {at(c)}) AS `{c}__lv`")
    ])
    earlier = over(series, "_chunk", "1 PRECEDING")
    later = over(series, "_chunk DESC", "1 PRECEDING")
    carried = ends.selectExpr(*[f"`{k}`" for k in keys], "_chunk", *[
        f"last(`{c}__{end}`) IGNORE NULLS {frame} AS `{c}__c{out}`"
        for c in columns
        for end, frame, out in (
            ("lp", earlier, "pp"), ("lv", earlier, "pv"), ("fp", later, "np"), ("fv", later, "nv"))
    ])
    facts = [] if known is None else [c for c in known.columns if c not in keys]
    if known is not None:
        carried = carried.join(known, keys)
    # The second frame runs backwards: a frame open towards the end of the
    # partition would be evaluated anew for every row.
    upto = over(f"{series}, _chunk", "_pos", "CURRENT ROW")
    down = over(f"{series}, _chunk", "_pos DESC", "CURRENT ROW")
    joined = df.join(carried, [*keys, "_chunk"])
    return joined.selectExpr(*[f"`{x}`" for x in [*df.columns, *facts] if x != "_chunk"], *[
        f"coalesce(last({x}) IGNORE NULLS {frame}, `{c}__c{out}`) AS `{c}__{out}`"
        for c in columns
        for x, frame, out in (
            (at(c), upto, "pp"), (f"`{c}`", upto, "pv"), (at(c), down, "np"), (f"`{c}`", down, "nv"))
    ])


def filled(c: str, rule: Fill) -> Column:
    """Filled value of column c over the output of `neighbours`."""
    value, pp, pv, np, nv = (f"`{c}{x}`" for x in ("", "__pp", "__pv", "__np", "__nv"))

    def line(at: str) -> str:
        return (f"CASE WHEN {pp} IS NOT NULL AND {np} IS NOT NULL THEN {pv} + ({nv} - {pv}) * ({at} - {pp}) "
                f"/ greatest({np} - {pp}, 1) ELSE coalesce({pv}, {nv}) END")

    cases = [f"WHEN {value} IS NOT NULL THEN {value}"]
    if rule.reach is None:
        cases.append(f"ELSE {line('_pos')}")
    else:
        back, ahead, reach = f"_pos - {pp}", f"{np} - _pos", f"({rule.reach})"
        cases.append(f"WHEN {back} <= {reach} OR {ahead} <= {reach} THEN {line('_pos')}")
        if rule.carry:
            cases.append(f"WHEN {back} <= {reach} + {rule.carry} THEN {line(f'{pp} + {reach}')}")
            if rule.backward:
                cases.append(f"WHEN {ahead} <= {reach} + {rule.carry} THEN {line(f'{np} - {reach}')}")
    return F.expr(f"CASE {' '.join(cases)} END")


def fill_gaps(df: DataFrame, keys, position: Column, rules: dict[str, Fill],
              length: int = chunks.LENGTH) -> DataFrame:
    """Fill the columns named in `rules`; all share one shuffle and one sort each way."""
    if not rules:
        return df
    near = neighbours(df, keys, position, rules, length)
    return near.select(*[filled(c, rules[c]).alias(c) if c in rules else c for c in df.columns])


def missing_share(df: DataFrame, keys, columns) -> DataFrame:
    """Per series: `n_rows`, and `c__missing` (count) and `c__missing_pct` per column."""
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.expr(f"count_if(`{c}` IS NULL) AS `{c}__missing`") for c in columns],
    )
    return counted.selectExpr("*", *[f"`{c}__missing` * 100D / n_rows AS `{c}__missing_pct`" for c in columns])


def out_of_range(c: str, ranges) -> Column:
    low, high = ranges[c]
    return (F.col(c) < F.lit(low)) | (F.col(c) > F.lit(high))


def fill_pollutants(df: DataFrame, keys, position: Column, ranges: dict,
                    stage=lambda df: df, length: int = chunks.LENGTH) -> DataFrame:
    """Limited linear fill, then implausible values out, refilled and clipped.

    A column of a series that had nothing missing stays as it is. Only where
    the first fill left a value out of range is the column blanked there,
    filled a second time and clipped. `stage` may write the first pass.
    """
    columns = [c for c in ranges if c in df.columns]
    once = fill_gaps(
        df.select("*", *[F.col(c).isNull().alias(f"{c}__was_null") for c in columns]),
        keys, position, {c: LIMITED for c in columns}, length,
    )
    once = stage(once)
    redo = once.groupBy(*keys).agg(*[
        (F.max(f"{c}__was_null") & F.coalesce(F.max(out_of_range(c, ranges)), F.lit(False))).alias(f"{c}__redo")
        for c in columns
    ])
    # Blanked for all series; where the flag says no, the first pass stays.
    blanked = once.select("*", *[
        F.when(~F.coalesce(out_of_range(c, ranges), F.lit(False)), F.col(c)).alias(f"{c}__in") for c in columns])
    near = neighbours(blanked, keys, position, [f"{c}__in" for c in columns], length, redo)
    return near.select(*[
        F.when(F.col(f"{c}__redo"), clip(filled(f"{c}__in", LIMITED), *ranges[c])).otherwise(F.col(c)).alias(c)
        if c in columns else F.col(c)
        for c in df.columns
    ])


def gaussian(keys, seed: int) -> Column:
    """Standard normal number that depends on the key columns and the seed only."""
    def uniform(salt: int) -> Column:
        bits = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed), F.lit(salt)), F.lit(1 << 52))
        return (bits + F.lit(0.5)) / F.lit(float(1 << 52))
    return F.sqrt(F.lit(-2.0) * F.ln(uniform(1))) * F.cos(F.lit(2 * math.pi) * uniform(2))


def fill_weather(df: DataFrame, keys, date: str, columns, noise: float = 0.0, seed: int = 42,
                 sparse_pct: float = 10.0, length: int = chunks.LENGTH) -> DataFrame:
    """Weather columns, by how much of the series is missing.

    Below `sparse_pct` percent: linear without limit. From there on: linear
    up to 30 rows, and what is left takes the mean of its calendar month
    (taken before filling) plus `noise` x standard deviation (taken after) x
    a repeatable normal number.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    keys = list(keys)
    position = chunks.day(F.col(date))
    share = missing_share(df, keys, columns).select(
        *keys, *[(F.col(f"{c}__missing_pct") < sparse_pct).alias(f"{c}__dense") for c in columns])
    # Twelve means per series and column.
    months = df.groupBy(*keys, F.month(date).alias("_month")).agg(*[F.avg(c).alias(c) for c in columns])
    months = months.groupBy(*keys).agg(*[
        F.map_from_entries(F.collect_list(F.struct("_month", c))).alias(f"{c}__months") for c in columns])
    near = neighbours(df, keys, position, columns, length, share.join(months, keys))
    lined = near.select(*df.columns, *[f"{c}__dense" for c in columns], *[
        F.try_element_at(f"{c}__months", F.month(date)).alias(f"{c}__month") for c in columns], *[
        # No limit is a reach longer than any series.
        filled(c, Fill(reach=f"CASE WHEN `{c}__dense` THEN {1 << 40} ELSE 30 END")).alias(f"{c}__lined")
        for c in columns
    ])
    if noise:
        spread = lined.groupBy(*keys).agg(*[F.stddev_samp(f"{c}__lined").alias(f"{c}__std") for c in columns])
        lined = lined.join(spread, keys)

    def rest(c: str) -> Column:
        base = F.col(f"{c}__month")
        if not noise:
            return base
        shift = F.lit(noise) * F.col(f"{c}__std") * gaussian([*keys, date], seed + columns.index(c))
        return base + F.when(F.col(f"{c}__std") > 0, shift).otherwise(F.lit(0.0))

    return lined.select(*[
        F.when(F.col(f"{c}__dense"), F.col(f"{c}__lined"))
        .otherwise(F.coalesce(F.col(f"{c}__lined"), rest(c))).alias(c)
        if c in columns else F.col(c)
        for c in df.columns
    ])


def fill_by_share(df: DataFrame, keys, position: Column, columns, rule: Fill, below_pct: float,
                  length: int = chunks.LENGTH) -> DataFrame:
    """Apply `rule` to a column of a series only while less than `below_pct` percent is missing."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    share = missing_share(df, keys, columns).select(
        *keys, *[F.expr(f"`{c}__missing` < n_rows * {below_pct / 100.0!r}D AS `{c}__few`") for c in columns])
    near = neighbours(df, keys, position, columns, length, share)
    return near.select(*[
        F.when(F.col(f"{c}__few"), filled(c, rule)).otherwise(F.col(c)).alias(c) if c in columns else c
        for c in df.columns
    ])


def fill_report(before: DataFrame, after: DataFrame, keys, columns) -> DataFrame:
    """Per series and column: missing before, after and filled."""
    def tall(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy(*keys).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        return counts.unpivot(list(keys), list(columns), "column", name)
    joined = tall(before, "missing_before").join(tall(after, "missing_after"), [*keys, "column"])
    return joined.withColumn("filled", F.col("missing_before") - F.col("missing_after"))
