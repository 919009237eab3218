"""Verdicts on single numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hazegrid import catalog
from hazegrid.functions.numeric import banded


def strength(r: Column) -> Column:
    label = banded(F.abs(r), catalog.STRENGTH_TOPS, catalog.STRENGTH_ABOVE, strict=True)
    return F.when(r.isNotNull(), label)


def direction(r: Column) -> Column:
    return F.when(r > 0, F.lit(catalog.DIRECTION_UP)).when(
        r.isNotNull(), F.lit(catalog.DIRECTION_DOWN)
    )


def trend_verdict(change: Column) -> Column:
    return (
        F.when(change < -5, F.lit(catalog.TREND_IMPROVED))
        .when(change > 5, F.lit(catalog.TREND_WORSE))
        .when(change.isNotNull(), F.lit(catalog.TREND_STABLE))
    )
