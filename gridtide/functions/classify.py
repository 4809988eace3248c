"""Ordered classification and the label sets built on it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from . import fixed_values as fixed
from .keys import as_column


def bucket(rules: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """Label of the first condition that holds. Without a default, no match gives NULL."""
    label = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        label = F.when(condition, value) if label is None else label.when(condition, value)
    if default is None:
        return label
    return label.otherwise(default if isinstance(default, Column) else F.lit(default))


def label_by_code(code: Column | str, labels: Iterable[tuple[object, object]], default: object = None) -> Column:
    code = as_column(code)
    return bucket([(code == key, value) for key, value in labels], default)


def truth(condition: Column) -> Column:
    """A flag that is false, not NULL, when the condition cannot be decided."""
    return F.coalesce(condition, F.lit(False))


def day_part(hour: Column | str) -> Column:
    hour = as_column(hour)
    return bucket([(hour.between(lo, hi), name) for name, lo, hi in fixed.DAY_PARTS], fixed.DAY_PART_DEFAULT)


def temperature_category(temperature: Column | str) -> Column:
    t = as_column(temperature)
    bands = [(t > bound, name) for name, bound in fixed.TEMPERATURE_BANDS]
    return bucket([(t.isNull(), fixed.TEMPERATURE_MISSING), *bands], fixed.TEMPERATURE_BELOW_ALL)


def county(latitude: Column | str, longitude: Column | str, boxes=fixed.COUNTY_BOXES) -> Column:
    lat, lon = as_column(latitude), as_column(longitude)
    inside = [(lat.between(*lats) & lon.between(*lons), name) for name, lats, lons in boxes]
    return bucket([(lat.isNull(), fixed.COUNTY_MISSING), *inside], fixed.COUNTY_OTHER)


def is_renewable(fuel: Column | str) -> Column:
    return truth(as_column(fuel).isin(fixed.RENEWABLE_FUELS))


def is_fossil(fuel: Column | str) -> Column:
    return truth(as_column(fuel).isin(fixed.FOSSIL_FUELS))


def primary_category(fuel: Column | str, renewable: Column | str, fossil: Column | str) -> Column:
    fuel = as_column(fuel)
    return bucket(
        [
            (as_column(renewable), "Renewable"),
            (as_column(fossil), "Fossil Fuel"),
            (fuel == fixed.NUCLEAR_FUEL, "Nuclear"),
            (fuel == fixed.ALL_FUELS, "All Sources"),
        ],
        "Other",
    )


def emission_factor(fuel: Column | str) -> Column:
    """Tons CO2 per MWh."""
    return label_by_code(fuel, fixed.EMISSION_TONS_PER_MWH, 0.0)
