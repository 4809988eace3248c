"""Arithmetic with the NULL and zero rules the measures need."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed_values as fixed
from .keys import as_column


def safe_div(numerator: Column | str, denominator: Column | str) -> Column:
    """NULL when either side is NULL or the denominator is 0."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))


def percent_of(part: Column | str, whole: Column | str) -> Column:
    return safe_div(part, whole) * 100.0


def parse_number(text: Column) -> Column:
    """Text to double; NULL for anything that is not a plain decimal number."""
    plain = text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    return F.when(plain, text.try_cast("double"))


def degree_days(temperature: Column | str, base: float = fixed.DEGREE_BASE_C) -> tuple[Column, Column]:
    """Heating and cooling degrees. ``greatest`` skips NULL, so a missing reading is kept NULL here."""
    t = as_column(temperature)
    heating = F.when(t.isNotNull(), F.greatest(F.lit(0.0), F.lit(base) - t))
    cooling = F.when(t.isNotNull(), F.greatest(F.lit(0.0), t - F.lit(base)))
    return heating, cooling


def wind_chill(temperature: Column | str, wind: Column | str) -> Column:
    """Felt temperature in cold wind, else the temperature itself. Wind enters in its given unit."""
    t, v = as_column(temperature), as_column(wind)
    factor = F.pow(v, F.lit(fixed.WIND_CHILL_EXPONENT))
    chilled = (
        F.lit(fixed.WIND_CHILL_CONSTANT)
        + fixed.WIND_CHILL_TEMPERATURE * t
        - fixed.WIND_CHILL_WIND * factor
        + fixed.WIND_CHILL_CROSS * t * factor
    )
    applies = (t < fixed.WIND_CHILL_BELOW_C) & (v > fixed.WIND_CHILL_ABOVE_WIND)
    return F.when(applies, chilled).otherwise(t)
