"""Derived weather quantities."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

KELVIN = 273.15


def _vapour(celsius: Column) -> Column:
    return F.exp(F.lit(17.27) * celsius / (celsius + F.lit(237.3)))


def relative_humidity(temperature: Column, dew_point: Column) -> Column:
    """Magnus relation from Kelvin inputs, bounded to 0..100 percent."""
    air = temperature - F.lit(KELVIN)
    dew = dew_point - F.lit(KELVIN)
    percent = F.lit(100.0) * _vapour(dew) / _vapour(air)
    # Bounded here and not by `clip`, which would evaluate the relation more than once.
    return F.when(
        temperature.isNotNull() & dew_point.isNotNull(), F.least(F.greatest(percent, F.lit(0.0)), F.lit(100.0)))


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_direction(u: Column, v: Column) -> Column:
    """Degrees clockwise from north, 0 up to but not including 360."""
    return F.pmod(F.degrees(F.atan2(u, v)) + F.lit(360.0), F.lit(360.0))


def to_celsius(temperature: Column) -> Column:
    """Readings above 50 can only be Kelvin."""
    return F.when(temperature > 50, temperature - F.lit(KELVIN)).otherwise(temperature)
