"""Rule-based recommendations for a forecast."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hazegrid import catalog
from hazegrid.functions import air, weather
from hazegrid.functions.numeric import lookup


def weather_flags(date: Column, temperature: Column) -> dict[str, Column]:
    """Winter, flower-season (1 Oct to 15 Nov), cold and hot; temperature in K or C."""
    celsius = weather.to_celsius(temperature)
    month = F.month(date)
    return {
        "is_winter": month.isin(12, 1, 2),
        "is_flower_season": (month == 10) | ((month == 11) & (F.dayofmonth(date) <= 15)),
        "is_cold": F.coalesce(celsius < 20, F.lit(False)),
        "is_hot": F.coalesce(celsius > 30, F.lit(False)),
    }


def _texts(actions) -> Column:
    return F.array(*[F.lit(a) for a in actions])


def recommendation(aqi: Column, date: Column, temperature: Column,
                   category: Column | None = None) -> dict[str, Column]:
    """Title, health note and ordered list of actions.

    The category is read in many places: give its column where the table has one.
    """
    name = air.category(aqi) if category is None else category
    flags = weather_flags(date, temperature)
    titles = {c: texts[0] for c, texts in catalog.ADVICE.items()}
    health = {c: texts[1] for c, texts in catalog.ADVICE.items()}
    mask = name.isin("Unhealthy", "Very Unhealthy", "Hazardous")
    by_category = (
        F.when(name == "Good", _texts(catalog.ACTIONS_GOOD))
        .when(name == "Moderate", _texts(catalog.ACTIONS_MODERATE))
        .when(mask, _texts((catalog.ACTION_MASK,) + catalog.ACTIONS_UNHEALTHY))
        .when(name == "Unhealthy for Sensitive", _texts(catalog.ACTIONS_UNHEALTHY))
        .otherwise(F.array().cast("array<string>"))
    )
    before, after = catalog.ACTION_FLOWER
    flower = F.concat(F.lit(before), F.date_format(date, "dd/MM"), F.lit(after))
    extras = F.array_compact(F.array(
        F.when(flags["is_winter"] | flags["is_cold"], F.lit(catalog.ACTION_COLD)),
        F.when(flags["is_hot"], F.lit(catalog.ACTION_HOT)),
        F.when(flags["is_flower_season"], flower),
    ))
    return {
        "category": name,
        "title": lookup(name, titles, F.lit(titles[catalog.ADVICE_DEFAULT])),
        "health": lookup(name, health, F.lit(health[catalog.ADVICE_DEFAULT])),
        "actions": F.concat(by_category, extras),
    }
