"""Calendar, energy-source and location dimensions, and the authority–station bridge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import calendar as cal, classify, fixed_values as fixed
from ..functions.keys import surrogate_key
from ..operators.dedup import number_rows
from ..operators.joins import build_bridge, lookup
from ..sources.inline import date_spine, inline_table


def dim_date(
    spark: SparkSession,
    start: str,
    n: int,
    as_of: str | None = None,
    holiday_offsets: tuple[int, int] = fixed.FLOATING_HOLIDAY_OFFSETS,
) -> DataFrame:
    """One row per day of a generated calendar, see :func:`describe_dates`. It has to span all facts that meet it:
    ``describe_dates`` over ``spanning_spine`` of their dates takes the span from them."""
    return describe_dates(date_spine(spark, start, n), as_of, holiday_offsets)


def describe_dates(
    spine: DataFrame, as_of: str | None = None, holiday_offsets: tuple[int, int] = fixed.FLOATING_HOLIDAY_OFFSETS
) -> DataFrame:
    """Calendar attributes of dates. ``as_of`` marks the current date; without it no day is current.

    Unordered; sort by date to show.
    """
    d = F.col("date")
    quarter = F.quarter(d).cast("string")
    current = F.lit(False) if as_of is None else d == F.lit(as_of).cast("date")
    return spine.select(
        "date",
        cal.date_id(d).alias("date_id"),
        F.dayofmonth(d).alias("day_of_month"),
        cal.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        cal.weekday(d).isin(0, 6).alias("is_weekend"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), quarter, F.lit("-"), F.year(d).cast("string")).alias("quarter_year"),
        F.year(d).alias("year"),
        cal.season(d).alias("season"),
        cal.is_holiday(d, holiday_offsets).alias("is_holiday"),
        F.add_months(d, -12).alias("prior_year_date"),
        F.add_months(d, -1).alias("prior_month_date"),
        current.alias("is_current_date"),
    )


def dim_energy_source(generation: DataFrame) -> DataFrame:
    """One row per fuel with its newest name, category, carbon intensity and flags."""
    fuels = generation.groupBy("fuel_type_id", "is_renewable", "is_fossil_fuel").agg(_newest(generation, "fuel_type_name"))
    attributes = inline_table(
        generation.sparkSession,
        fixed.FUEL_ATTRIBUTES,
        "fuel_type_id string, _category string, carbon_intensity_kg_per_mwh int, is_dispatchable boolean",
    )
    described = lookup(number_rows(fuels, "fuel_type_id", "source_key"), attributes, ["fuel_type_id"])
    return described.select(
        surrogate_key("fuel_type_id").alias("source_id"),
        "source_key",
        "fuel_type_id",
        "fuel_type_name",
        F.coalesce("_category", "fuel_type_name").alias("source_category"),
        classify.primary_category("fuel_type_id", "is_renewable", "is_fossil_fuel").alias("primary_category"),
        "is_renewable",
        "is_fossil_fuel",
        classify.truth(F.col("fuel_type_id") == fixed.NUCLEAR_FUEL).alias("is_nuclear"),
        "carbon_intensity_kg_per_mwh",
        "is_dispatchable",
    )


def _newest(records: DataFrame, name: str) -> Column:
    """The name in the newest record of a code, so that a renamed code stays one row; without lineage the largest."""
    order = [c for c in ("source_timestamp", "source_id") if c in records.columns]
    return F.max_by(name, F.struct(*order, name)).alias(name)


def _place(code, state, kind: str, county=None, city=None, latitude=None, longitude=None) -> list[Column]:
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    return [
        F.col(code).alias("location_code"),
        state.alias("state_name"),
        F.lit(kind).alias("location_type"),
        (text if county is None else county).alias("county"),
        (text if city is None else city).alias("city"),
        (number if latitude is None else latitude).alias("latitude"),
        (number if longitude is None else longitude).alias("longitude"),
    ]


def state_places(generation: DataFrame) -> DataFrame:
    """States that report generation, by their newest name."""
    states = generation.groupBy("location_code").agg(_newest(generation, "state_name"))
    return states.select(_place("location_code", F.col("state_name"), fixed.STATE_TYPE))


def station_places(stations: DataFrame) -> DataFrame:
    """Weather stations."""
    details = [F.col(c) for c in ("county", "station_name", "latitude", "longitude")]
    return stations.select(_place("station_id", F.col("state"), fixed.STATION_TYPE, *details)).distinct()


def authority_places(demand: DataFrame, state: str = fixed.STATE_NAME) -> DataFrame:
    """Balancing authorities that report demand; undeduplicated records serve as well."""
    code = F.col("balancing_authority")
    name = classify.label_by_code(code, fixed.AUTHORITY_NAMES, code)
    return demand.select(
        _place("balancing_authority", F.lit(state), fixed.AUTHORITY_TYPE, city=name)
    ).distinct()


def describe_places(
    places: DataFrame, population: DataFrame, valid_from: str | None = None, valid_to: str | None = None
) -> DataFrame:
    """Places with key, population, geography level and validity dates (NULL is open)."""
    return lookup(places, population, ["location_code"]).select(
        surrogate_key("location_code", "location_type").alias("location_id"),
        "location_code",
        "state_name",
        "location_type",
        "county",
        "city",
        "latitude",
        "longitude",
        "population_millions",
        classify.label_by_code("location_type", fixed.GEOGRAPHY_LEVELS, fixed.GEOGRAPHY_DEFAULT).alias(
            "geography_level"
        ),
        F.lit(True).alias("is_active"),
        F.lit(valid_from).cast("date").alias("valid_from_date"),
        F.lit(valid_to).cast("date").alias("valid_to_date"),
    )


def dim_location(
    generation: DataFrame,
    stations: DataFrame,
    demand: DataFrame,
    population: DataFrame,
    valid_from: str | None = None,
    valid_to: str | None = None,
    state: str = fixed.STATE_NAME,
) -> DataFrame:
    """States, weather stations and balancing authorities in one dimension.

    The types keep the three inputs apart, so each is made distinct by itself and their union stays distinct.
    """
    every = state_places(generation).unionByName(station_places(stations)).unionByName(authority_places(demand, state))
    return describe_places(every, population, valid_from, valid_to)


def location_bridge(locations: DataFrame, pairs: DataFrame) -> DataFrame:
    return build_bridge(locations, pairs)
