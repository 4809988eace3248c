"""Declared data checks of every model, and the job that counts their violations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..operators.quality import run_checks

_HOURS = list(range(24))
_DAY_PARTS = ["MORNING_PEAK", "MIDDAY", "EVENING_PEAK", "OFF_PEAK"]
_DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
_SEASONS = ["Winter", "Spring", "Summer", "Fall"]
_TEMPERATURES = ["HOT", "WARM", "MILD", "COLD", "VERY_COLD", "UNKNOWN"]
_STATES = ["LOW", "NORMAL", "HIGH", "PEAK", "CRITICAL"]
_DRIVERS = ["WEATHER", "WEEKEND_EFFECT", "TIME_OF_DAY"]

# model -> not_null columns, accepted values, unique columns, foreign keys (column, parent model, parent column)
DECLARED = {
    "stage_demand": (["demand_id", "balancing_authority", "timestamp"], {}, ["demand_id"], []),
    "stage_sales": (
        ["sales_id", "period", "state_id", "sector_id", "sales_mwh", "sales_date", "grain_id"],
        {},
        ["sales_id"],
        [],
    ),
    "stage_weather": (["observation_id", "station_id", "timestamp"], {}, ["observation_id"], []),
    "station_metadata": (["station_id", "station_key"], {}, ["station_id", "station_key"], []),
    "stage_generation": (
        [
            "generation_id",
            "period",
            "location_code",
            "state_name",
            "fuel_type_id",
            "fuel_type_name",
            "sector_id",
            "sector_name",
            "is_renewable",
            "is_fossil_fuel",
            "generation_date",
            "grain_id",
        ],
        {},
        ["generation_id"],
        [],
    ),
    "dim_location": (["location_id", "location_code", "is_active"], {}, ["location_id"], []),
    "dim_energy_source": (
        ["source_id", "fuel_type_id", "is_renewable", "is_fossil_fuel"],
        {},
        ["source_id", "fuel_type_id"],
        [],
    ),
    "dim_date": (
        ["date", "date_id", "day_of_week", "day_name", "is_weekend", "month_number", "season"],
        {
            "day_of_week": list(range(7)),
            "day_name": _DAYS,
            "month_number": list(range(1, 13)),
            "season": _SEASONS,
        },
        ["date", "date_id"],
        [],
    ),
    "fact_demand": (
        ["date_id", "hour_of_day", "location_id", "timestamp", "demand_mwh", "is_negative_demand", "day_part"],
        {"hour_of_day": _HOURS, "day_part": _DAY_PARTS},
        [],
        [("date_id", "dim_date", "date_id"), ("location_id", "dim_location", "location_id")],
    ),
    "fact_weather": (
        ["date_id", "hour_of_day", "station_id", "timestamp"],
        {"hour_of_day": _HOURS, "temperature_category": _TEMPERATURES},
        [],
        [("date_id", "dim_date", "date_id"), ("location_id", "dim_location", "location_id")],
    ),
    "fact_generation": (
        [
            "date_id",
            "location_id",
            "energy_source_id",
            "generation_date",
            "generation_mwh",
            "percentage_of_total",
            "is_renewable",
            "is_fossil_fuel",
        ],
        {},
        [],
        [
            ("date_id", "dim_date", "date_id"),
            ("location_id", "dim_location", "location_id"),
            ("energy_source_id", "dim_energy_source", "source_id"),
        ],
    ),
    "fact_sales": (
        [
            "date_id",
            "location_id",
            "sector_id",
            "sales_date",
            "sales_mwh",
            "revenue_usd",
            "price_cents_per_kwh",
            "customer_count",
        ],
        {},
        [],
        [("date_id", "dim_date", "date_id"), ("location_id", "dim_location", "location_id")],
    ),
    # The models below have no declared checks of their own; their keys and labels are checked as well.
    "location_bridge": (
        ["balancing_authority_id", "weather_station_id"],
        {},
        [],
        [
            ("balancing_authority_id", "dim_location", "location_id"),
            ("weather_station_id", "dim_location", "location_id"),
        ],
    ),
    "peak_drivers": (
        ["peak_driver_id", "is_peak_hour", "primary_driver"],
        {"primary_driver": _DRIVERS},
        ["peak_driver_id"],
        [],
    ),
    "grid_state_changes": (
        ["state_change_id", "from_state", "to_state", "change_trigger"],
        {"from_state": _STATES, "to_state": _STATES},
        ["state_change_id"],
        [],
    ),
}


def check_model(model: str, models: Mapping[str, DataFrame]) -> DataFrame:
    """Violation counts of one model; ``models`` holds it and the parents of its foreign keys."""
    not_null, accepted, unique, foreign = DECLARED[model]
    parents = [(column, models[parent], parent_column) for column, parent, parent_column in foreign]
    return run_checks(model, models[model], not_null, accepted, unique, parents)
