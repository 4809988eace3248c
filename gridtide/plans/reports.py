"""The tables behind the five dashboard panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def state_timeline(changes: DataFrame) -> DataFrame:
    return changes.select(
        "balancing_authority_id", "state_change_timestamp", "to_state", "change_trigger", "temperature_c"
    )


def drivers_long(drivers: DataFrame) -> DataFrame:
    """One row per demand hour and driver."""
    wide = drivers.select(
        "peak_driver_id",
        "timestamp",
        "is_peak_hour",
        F.col("weather_contribution_mwh").alias("WEATHER_IMPACT"),
        F.col("weekend_contribution_mwh").alias("WEEKEND_IMPACT"),
        F.col("time_of_day_contribution_mwh").alias("TIME_OF_DAY_IMPACT"),
    )
    return wide.unpivot(
        ["peak_driver_id", "timestamp", "is_peak_hour"],
        ["WEATHER_IMPACT", "WEEKEND_IMPACT", "TIME_OF_DAY_IMPACT"],
        "driver",
        "contribution_mwh",
    )


def peak_timeline(drivers: DataFrame) -> DataFrame:
    return drivers.select("location_id", "timestamp", "demand_mwh", "is_peak_hour", "temperature_c")


def daily_correlation(correlation: DataFrame) -> DataFrame:
    return correlation.select(
        "balancing_authority_id", "date", "daily_demand_mwh", "regional_avg_temp_c", "temp_demand_correlation"
    )


def trailing_averages(patterns: DataFrame) -> DataFrame:
    return patterns.select(
        "balancing_authority_id",
        "date",
        "daily_demand_mwh",
        "trailing_7d_avg_demand",
        "trailing_30d_avg_demand",
        "trailing_90d_avg_demand",
    )
