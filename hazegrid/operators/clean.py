"""Sentinels, outliers, coverage and missing-value profiles of long series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hazegrid import catalog
from hazegrid.functions.numeric import lookup, percent
from hazegrid.operators.quantiles import exact_quantiles


def is_sentinel(value: Column, fill: Column) -> Column:
    """Equal for large declared fill values, else equal within 1e-10."""
    near = F.abs(value - fill) <= F.lit(1e-10) + F.lit(1e-10) * F.abs(fill)
    return F.coalesce(F.when(F.abs(fill) > 1e6, value == fill).otherwise(near), F.lit(False))


def drop_sentinels(value: Column, fill: Column) -> Column:
    return F.when(~is_sentinel(value, fill), value)


def is_extreme(value: Column) -> Column:
    return (F.abs(value) > 1e12) | (value < -1e15)


def sweep_near_sentinels(df: DataFrame, keys, value: str = "value", fill: str = "fill_value",
                         few_groups: bool = False) -> DataFrame:
    """Blank extreme values within 1 % of a huge declared fill value.

    Applies to series whose extreme rows exceed 0.1 % of the present ones.
    `few_groups` states that the number of series is bounded by a fixed list;
    the one row per series is then broadcast and the readings stay in place.
    """
    v, f = F.col(value), F.col(fill)
    rate = df.groupBy(*keys).agg(
        (F.count_if(is_extreme(v)) * 100.0 > F.count(v) * 0.1).alias("_sweep"))
    near = F.abs(v - f) <= F.lit(0.01) * F.abs(f)
    hit = F.col("_sweep") & (F.abs(f) > 1e10) & is_extreme(v) & near
    swept = F.when(~F.coalesce(hit, F.lit(False)), v)
    rate = F.broadcast(rate) if few_groups else rate
    return df.join(rate, list(keys)).withColumn(value, swept).drop("_sweep")


def outlier_report(df: DataFrame, keys, value: str = "value", above_pct: float = 5.0,
                   few_groups: bool = False) -> DataFrame:
    """Series with more than `above_pct` percent outside 3 x IQR; rows are not touched."""
    fences = exact_quantiles(df, keys, value, (0.25, 0.75), few_groups).select(
        *keys, F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    if few_groups:
        fences = F.broadcast(fences)
    spread = F.col("q3") - F.col("q1")
    outside = (F.col(value) < F.col("q1") - 3 * spread) | (F.col(value) > F.col("q3") + 3 * spread)
    return (
        df.filter(F.col(value).isNotNull()).join(fences, list(keys))
        .groupBy(*keys, "q1", "q3")
        .agg(F.count_if(outside).alias("outliers"), F.count(F.lit(1)).alias("valid"))
        .withColumn("outlier_pct", percent(F.col("outliers"), F.col("valid")))
        .filter(F.col("outlier_pct") > above_pct)
    )


def valid_ratio(df: DataFrame, keys, value: str = "value") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), F.count(value).alias("valid"),
    ).withColumn("valid_pct", percent(F.col("valid"), F.col("total")))


def from_date(df: DataFrame, ts: str, start) -> DataFrame:
    """Rows from `start` on; a series without any disappears."""
    return df.filter(F.col(ts) >= F.lit(start).cast(df.schema[ts].dataType))


def late_starts(df: DataFrame, feature: str, ts: str, start, reasons: dict | None = None) -> DataFrame:
    """Series that begin after `start`, with the known reason if any."""
    reasons = catalog.MISSING_REASONS if reasons is None else reasons
    begins = df.groupBy(feature).agg(F.min(F.col(ts).cast("date")).alias("first_date"))
    return begins.filter(F.col("first_date") > F.lit(start).cast("date")).withColumn(
        "reason", lookup(F.col(feature), reasons))


def missing_profile(df: DataFrame, columns=None) -> DataFrame:
    """Null count and percentage per column, in one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *[
        F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot(["n_rows"], columns, "column", "missing").select(
        "column", "missing", percent(F.col("missing"), F.col("n_rows")).alias("missing_pct"))


def completeness(df: DataFrame, columns=None) -> DataFrame:
    """Rows, cells, missing cells, complete and incomplete rows."""
    columns = list(columns or df.columns)
    gaps = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    return df.select(gaps.alias("gaps")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.count(F.lit(1)) * len(columns)).alias("cells"),
        F.coalesce(F.sum("gaps"), F.lit(0)).cast("long").alias("missing_cells"),
        F.count_if(F.col("gaps") == 0).alias("complete_rows"),
        F.count_if(F.col("gaps") > 0).alias("incomplete_rows"),
    )


def fill_with_means(df: DataFrame, columns, keys=()) -> DataFrame:
    """Replace nulls by the mean of the column, over the table or per series."""
    columns, keys = list(columns), list(keys)

    def replaced(c: str, mean: Column) -> Column:
        return F.coalesce(F.col(c), mean).alias(c)

    if keys:
        means = df.groupBy(*keys).agg(*[F.avg(c).alias(f"{c}__mean") for c in columns])
        return df.join(means, keys).select(*[
            replaced(c, F.col(f"{c}__mean")) if c in columns else F.col(c) for c in df.columns])
    # One scalar subquery: computed once, inlined as a constant, no join.
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("means")).scalar()
    return df.select(*[
        replaced(c, means.getField(c)) if c in columns else F.col(c) for c in df.columns])


def in_order(columns, wanted) -> list[str]:
    """Columns of `wanted` that exist, in its order, then the others."""
    present = [c for c in wanted if c in columns]
    return present + [c for c in columns if c not in present]


def feature_columns(columns, targets=catalog.TARGETS, excluded=catalog.NOT_FEATURES) -> list[str]:
    return [c for c in columns if c not in set(excluded) | set(targets)]
