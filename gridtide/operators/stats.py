"""Rollups, baselines, sensitivities and decompositions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as fixed
from ..functions.classify import bucket
from ..functions.keys import as_column
from ..functions.numeric import percent_of, safe_div


def daily_rollup(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sum, mean, peak and sample deviation of a reading per key (NULL readings are left out)."""
    return df.groupBy(*keys).agg(
        F.sum(value).alias("total"),
        F.avg(value).alias("mean"),
        F.max(value).alias("peak"),
        F.stddev_samp(value).alias("deviation"),
    )


def weather_rollup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hourly weather to one row per key (a station's day)."""
    t = F.col("temperature_c")
    return df.groupBy(*keys).agg(
        F.avg(t).alias("avg_temp_c"),
        F.max(t).alias("max_temp_c"),
        F.min(t).alias("min_temp_c"),
        (F.max(t) - F.min(t)).alias("temp_range_c"),
        F.sum("heating_degree_c").alias("heating_degree_day_c"),
        F.sum("cooling_degree_c").alias("cooling_degree_day_c"),
        F.avg("wind_speed_ms").alias("avg_wind_speed_ms"),
        F.max("wind_speed_ms").alias("max_wind_speed_ms"),
        F.count_if(t > fixed.TEMPERATURE_BANDS[0][1]).alias("hot_hours"),
        F.count_if(t < 0).alias("freezing_hours"),
    )


def share(condition: Column | str, value: Column | str) -> Column:
    """Aggregate: percent of the summed value that meets the condition; NULL when the sum is 0."""
    value = as_column(value)
    return percent_of(F.sum(F.when(as_column(condition), value).otherwise(0.0)), F.sum(value))


def baseline(df: DataFrame, by: Sequence[str], value: str, output: str) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(value).alias(output))


def sensitivity(x: Column | str, y: Column | str, prefix: str = "") -> list[Column]:
    """Aggregates: correlation of x and y, and the slope of y over x. Rows with either missing are left out."""
    x, y = as_column(x), as_column(y)
    return [
        F.corr(x, y).alias(f"{prefix}temp_demand_correlation"),
        F.regr_slope(y, x).alias(f"{prefix}temp_sensitivity_mwh_per_degree"),
    ]


def band_means(temperature: Column | str, value: Column | str) -> list[Column]:
    """Aggregates: mean value on hot, mild and cold days."""
    t, v = as_column(temperature), as_column(value)
    return [
        F.avg(F.when(t > fixed.HOT_DAY_ABOVE_C, v)).alias("hot_weather_avg_demand"),
        F.avg(F.when(t.between(*fixed.MILD_DAY_C), v)).alias("mild_weather_avg_demand"),
        F.avg(F.when(t < fixed.COLD_DAY_BELOW_C, v)).alias("cold_weather_avg_demand"),
    ]


def decompose(
    demand: Column | str,
    temperature: Column | str,
    mean_temperature: Column | str,
    slope: Column | str,
    is_weekend: Column | str,
    weekday_mean: Column | str,
    season_mean: Column | str,
) -> dict[str, Column]:
    """Weather, weekend and time-of-day parts of a demand reading, each in percent of it, and the remainder.

    A part that cannot be computed is NULL (and makes the remainder NULL), except weather without a reading or a
    slope and the weekend part of a weekday, which are 0.
    """
    demand, temperature, slope = as_column(demand), as_column(temperature), as_column(slope)
    parts = {
        "weather_contribution": F.when(
            slope.isNotNull() & temperature.isNotNull(), (temperature - as_column(mean_temperature)) * slope
        ).otherwise(0.0),
        "weekend_contribution": F.when(as_column(is_weekend), demand - as_column(weekday_mean)).otherwise(0.0),
        "time_of_day_contribution": demand - as_column(season_mean),
    }
    positive = demand > 0
    columns = {f"{name}_mwh": part for name, part in parts.items()}
    columns |= {
        f"{name}_percent": F.when(positive, percent_of(part, demand)).otherwise(0.0) for name, part in parts.items()
    }
    weather, weekend, time_of_day = parts.values()
    columns["unexplained_demand_mwh"] = F.when(positive, demand - (weather + weekend + time_of_day)).otherwise(0.0)
    columns["primary_driver"] = primary_driver(weather, weekend, time_of_day)
    return columns


def primary_driver(weather: Column, weekend: Column, time_of_day: Column) -> Column:
    """The part that is strictly largest by size; time of day otherwise."""
    a, b, c = F.abs(weather), F.abs(weekend), F.abs(time_of_day)
    return bucket([((a > b) & (a > c), "WEATHER"), ((b > a) & (b > c), "WEEKEND_EFFECT")], "TIME_OF_DAY")


def expected_and_anomaly(
    demand: Column | str, temperature: Column | str, slope: Column | str, mean: Column | str
) -> tuple[Column, Column]:
    """Demand expected from temperature (not centred), and what the actual demand differs from it by."""
    expected = as_column(temperature) * as_column(slope) + as_column(mean)
    return expected, as_column(demand) - expected


def weekend_ratio(demand: Column | str, is_weekend: Column | str, weekday_mean: Column | str) -> Column:
    """Weekend demand over the weekday mean; 1 on weekdays."""
    return F.when(as_column(is_weekend), safe_div(demand, weekday_mean)).otherwise(1.0)
