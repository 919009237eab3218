"""Air-quality index: concentrations, sub-indices, index and its bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from hazegrid import catalog
from hazegrid.functions.numeric import banded, clip


def micrograms(kilograms: Column) -> Column:
    """kg/m3 to ug/m3."""
    return kilograms * F.lit(1e9)


def coarse_from_fine(pm25: Column) -> Column:
    return pm25 * F.lit(1.6)


def concentration(component: str, column: str | None = None) -> Column:
    """Bring a component to the unit its breakpoints are given in."""
    value = F.col(column or component)
    if component == "CO":
        return value / F.lit(1000.0)
    factor, top = {
        "NO2_trop": (catalog.NO2_TO_PPB, 5000.0),
        "SO2_column": (catalog.SO2_TO_PPB, 5000.0),
        "O3": (catalog.O3_TO_PPB, 1000.0),
    }.get(component, (None, None))
    return value if factor is None else clip(value * F.lit(factor), 0.0, top)


def sub_index(conc: str, breakpoints) -> Column:
    """Piecewise-linear index of a concentration column, rounded half to even.

    Missing and negative concentrations have no index; beyond the last
    breakpoint it is 500. Segments are tried from the highest one down.
    """
    points = list(zip(breakpoints, catalog.INDEX_LEVELS))
    branches = [f"WHEN {conc} > {breakpoints[-1]!r}D THEN 500D"]
    for low, high in reversed(list(zip(points, points[1:]))):
        slope = (high[1] - low[1]) / (high[0] - low[0])
        above = ">" if low[1] else ">="
        branches.append(
            f"WHEN {conc} {above} {low[0]!r}D THEN rint({slope!r}D * ({conc} - {low[0]!r}D) + {low[1]}D)")
    return F.expr(f"CASE {' '.join(branches)} END")


def overall(indices) -> Column:
    """Largest sub-index; missing ones are skipped."""
    indices = list(indices)
    return F.greatest(*indices) if len(indices) > 1 else F.col(indices[0])


def dominant(indices: dict[str, str], top: str = "aqi") -> Column:
    """Name of the first component whose sub-index column reaches the largest."""
    (name, index), *rest = indices.items()
    return reduce(
        lambda case, item: case.when(F.col(item[1]) == F.col(top), F.lit(item[0])),
        rest,
        F.when(F.col(index) == F.col(top), F.lit(name)),
    )


def index_name(component: str) -> str:
    return f"aqi_{component}"


def category(aqi: Column) -> Column:
    return F.when(aqi.isNull(), F.lit(catalog.UNKNOWN)).otherwise(
        banded(aqi, catalog.CATEGORY_TOPS, catalog.CATEGORY_ABOVE)
    )


def pollution_level(aqi: Column) -> Column:
    return F.when(aqi.isNull(), F.lit(catalog.UNKNOWN)).otherwise(
        banded(aqi, catalog.LEVEL_TOPS, catalog.LEVEL_ABOVE)
    )


def report_band(aqi: Column) -> Column:
    """Five bands of the health report; a missing index lands in the last one."""
    return banded(aqi, catalog.CATEGORY_TOPS[:4], catalog.CATEGORY_TOPS[4][1])


def status(category_name: Column) -> Column:
    """Good and Moderate days are normal, all others (Unknown too) polluted."""
    return F.when(
        category_name.isin("Good", "Moderate"), F.lit(catalog.STATUS_NORMAL)
    ).otherwise(F.lit(catalog.STATUS_POLLUTED))


def severity(category_name: Column) -> Column:
    """Position of a category from clean to hazardous, Unknown last."""
    order = F.array(*[F.lit(c) for c in catalog.CATEGORIES + (catalog.UNKNOWN,)])
    return F.array_position(order, category_name).cast("int")
