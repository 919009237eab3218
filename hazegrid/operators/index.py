"""Air-quality index columns of a table.

Concentrations, sub-indices, index and category are added one after the
other: each step reads columns, so that no expression is evaluated twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazegrid import catalog
from hazegrid.functions import air


def components(columns) -> list[str]:
    return [c for c in catalog.COMPONENTS if c in columns]


def with_sub_indices(df: DataFrame) -> DataFrame:
    """Add `aqi_<component>` for every component the table has."""
    present = components(df.columns)
    # A missing concentration becomes a negative one, which has no index either:
    # comparing columns that cannot be null makes for much shorter code.
    conc = df.select("*", *[
        F.coalesce(air.concentration(c), F.lit(-1.0)).alias(f"_c_{c}") for c in present])
    return conc.select(*df.columns, *[
        air.sub_index(f"_c_{c}", catalog.BREAKPOINTS[c]).alias(air.index_name(c)) for c in present])


def with_index(df: DataFrame, keep_parts: bool = False) -> DataFrame:
    """Add `aqi` and `aqi_category`, and the sub-indices if wanted."""
    parts = [air.index_name(c) for c in components(df.columns)]
    out = with_sub_indices(df).select("*", air.overall(parts).alias("aqi"))
    out = out.select("*", air.category(F.col("aqi")).alias("aqi_category"))
    return out if keep_parts else out.drop(*parts)
