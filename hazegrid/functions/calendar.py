"""Calendar fields of a date column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hazegrid import catalog
from hazegrid.functions.numeric import lookup


def season_code(month: Column) -> Column:
    """0 Dec-Feb, 1 Mar-May, 2 Jun-Aug, 3 Sep-Nov."""
    return F.floor((month % 12) / 3).cast("int")


def season_name(code: Column) -> Column:
    return lookup(code, catalog.SEASON_NAMES, code.cast("string"))


def season_from_name(name: Column, month: Column) -> Column:
    """Code of a season given as a name or a number.

    A number outside 0..3 falls back to the month, an unknown name to winter.
    """
    number = name.try_cast("double")
    return (
        F.when(number.isin(0.0, 1.0, 2.0, 3.0), number.cast("int"))
        .when(name.isNull() | number.isNotNull(), season_code(month))
        .otherwise(lookup(name, catalog.SEASON_CODES, F.lit(0)))
    )


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def calendar_fields(date: Column) -> dict[str, Column]:
    weekday = F.weekday(date)
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "weekday": weekday,
        "day_of_year": F.dayofyear(date),
        "is_weekend": (weekday >= 5).cast("int"),
        "season": season_code(F.month(date)),
    }
