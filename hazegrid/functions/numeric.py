"""Null-preserving arithmetic helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def clip(value: Column, low: float, high: float) -> Column:
    """Bound `value`; a missing value stays missing (`least`/`greatest` skip nulls)."""
    return F.when(value < F.lit(low), F.lit(low)).when(value > F.lit(high), F.lit(high)).otherwise(value)


def round_even(value: Column, digits: int = 2) -> Column:
    """Round the way NumPy does: scale, round half to even, scale back."""
    scale = float(10 ** digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def ratio(top: Column, bottom: Column, otherwise: Column | None = None) -> Column:
    """top / bottom, or `otherwise` (null) where bottom is zero."""
    safe = F.when(bottom != 0, top / F.nullif(bottom, F.lit(0)))
    return safe if otherwise is None else F.coalesce(safe, otherwise)


def percent(part: Column, whole: Column) -> Column:
    return ratio(part * F.lit(100.0), whole)


def banded(value: Column, tops, above: str, strict: bool = False) -> Column:
    """Name of the first band whose top is not below `value`."""
    first, *rest = tops
    below = (lambda top: value < F.lit(top)) if strict else (lambda top: value <= F.lit(top))
    chain = reduce(
        lambda case, band: case.when(below(band[0]), F.lit(band[1])),
        rest,
        F.when(below(first[0]), F.lit(first[1])),
    )
    return chain.otherwise(F.lit(above))


def lookup(key: Column, table: dict, otherwise: Column | None = None) -> Column:
    """Value of a small fixed table as a map literal; null for an unknown key."""
    entries = F.create_map(*[F.lit(part) for item in table.items() for part in item])
    found = F.try_element_at(entries, key)
    return found if otherwise is None else F.coalesce(found, otherwise)
