"""Raw landed documents to clean records, one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import calendar as cal, classify, fixed_values as fixed
from ..functions.keys import number_text, surrogate_key
from ..functions.numeric import degree_days, parse_number
from ..operators.dedup import latest_by
from ..sources import landed


def demand_records(raw: DataFrame) -> DataFrame:
    """Every readable demand record of the raw documents, revisions included."""
    parsed = landed.parse_payload(raw, landed.DEMAND_PAYLOAD)
    records = landed.explode_payload(parsed, "raw_data.response.data")
    return records.withColumn("timestamp", cal.to_ntz("item.period")).filter(F.col("timestamp").isNotNull())


def stage_demand(raw: DataFrame) -> DataFrame:
    """Hourly demand, one row per authority and time: the newest upload wins.

    Raw columns: ``id, file_name, uploaded_at, data_date, balancing_authority, raw_data``.
    """
    records = demand_records(raw).select(
        "balancing_authority",
        "timestamp",
        parse_number(F.trim("item.value")).alias("demand_mwh"),
        F.col("item.value-units").alias("units"),
        F.col("id").alias("source_id"),
        "file_name",
        "data_date",
        F.col("uploaded_at").alias("source_uploaded_at"),
    )
    newest = latest_by(
        records,
        ["balancing_authority", "timestamp"],
        ["source_uploaded_at", "source_id", "file_name", "demand_mwh", "units"],
    )
    return newest.select(
        surrogate_key("balancing_authority", "timestamp").alias("demand_id"),
        "balancing_authority",
        "timestamp",
        F.to_date("timestamp").alias("date"),
        F.hour("timestamp").alias("hour_of_day"),
        classify.day_part(F.hour("timestamp")).alias("day_part"),
        "demand_mwh",
        "units",
        classify.truth(F.col("demand_mwh") < 0).alias("is_negative_demand"),
        "source_id",
        "file_name",
        "data_date",
        "source_uploaded_at",
    )


def stage_generation(raw: DataFrame) -> DataFrame:
    """Monthly generation in MWh, one row per period, location, fuel and sector."""
    parsed = landed.parse_payload(raw, landed.GENERATION_PAYLOAD)
    item = landed.explode_payload(parsed, "raw_data.response.data")
    records = item.select(
        F.col("item.period").alias("period"),
        F.col("item.location").alias("location_code"),
        F.col("item.stateDescription").alias("state_name"),
        F.col("item.fueltypeid").alias("fuel_type_id"),
        F.col("item.fuelTypeDescription").alias("fuel_type_name"),
        F.col("item.sectorid").alias("sector_id"),
        F.col("item.sectorDescription").alias("sector_name"),
        parse_number(F.trim("item.generation")).alias("reported"),
        F.col("item.generation-units").alias("generation_units"),
        F.col("uploaded_at").alias("source_timestamp"),
        F.col("id").alias("source_id"),
        F.col("file_name").alias("source_file"),
    )
    grain = ["period", "location_code", "fuel_type_id", "sector_id"]
    newest = latest_by(records, grain, ["source_timestamp", "source_id", "source_file", "reported", "generation_units"])
    scaled = (F.col("generation_units") == fixed.THOUSAND_MWH_UNIT) & F.col("reported").isNotNull()
    date = cal.month_date("period")
    return newest.select(
        surrogate_key(*grain).alias("generation_id"),
        "period",
        "location_code",
        "state_name",
        "fuel_type_id",
        "fuel_type_name",
        "sector_id",
        "sector_name",
        F.when(scaled, F.col("reported") * 1000.0).otherwise(F.col("reported")).alias("generation_mwh"),
        "generation_units",
        classify.is_renewable("fuel_type_id").alias("is_renewable"),
        classify.is_fossil("fuel_type_id").alias("is_fossil_fuel"),
        date.alias("generation_date"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        surrogate_key(*grain).alias("grain_id"),
        "source_timestamp",
        "source_id",
        "source_file",
    )


def stage_sales(raw: DataFrame, states: Sequence[str] | None = (fixed.STATE_CODE,)) -> DataFrame:
    """Monthly retail sales of the given states (None: all). A revision with other measures stays a row of its own."""
    parsed = landed.parse_payload(raw, landed.SALES_PAYLOAD)
    item = landed.explode_payload(parsed, "raw_data.response.data")
    if states is not None:
        item = item.filter(F.col("item.stateid").isin(list(states)))
    records = item.select(
        F.col("item.period").alias("period"),
        F.col("item.stateid").alias("state_id"),
        F.col("item.stateDescription").alias("state_name"),
        F.col("item.sectorid").alias("sector_id"),
        F.col("item.sectorName").alias("sector_name"),
        parse_number(F.trim("item.sales")).alias("sales_mwh"),
        parse_number(F.trim("item.revenue")).alias("revenue_usd"),
        parse_number(F.trim("item.price")).alias("price_cents_per_kwh"),
        F.round(parse_number(F.trim("item.customers"))).cast("long").alias("customer_count"),
        F.col("uploaded_at").alias("source_timestamp"),
        F.col("id").alias("source_id"),
        F.col("file_name").alias("source_file"),
    )
    measures = ["sales_mwh", "revenue_usd", "price_cents_per_kwh", "customer_count"]
    newest = latest_by(
        records,
        ["period", "state_id", "sector_id", *measures],
        ["source_timestamp", "source_id", "source_file"],
    )
    date = cal.month_date("period")
    grain = [number_text(m) if m != "customer_count" else F.col(m) for m in measures]
    return newest.select(
        surrogate_key("period", "state_id", "sector_id").alias("sales_id"),
        "period",
        "state_id",
        "state_name",
        "sector_id",
        "sector_name",
        *measures,
        date.alias("sales_date"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        surrogate_key("period", "state_id", "sector_id", *grain).alias("grain_id"),
        "source_timestamp",
        "source_id",
        "source_file",
    )


def stage_weather(raw: DataFrame, per_hour: bool = False) -> DataFrame:
    """Weather readings, one row per station and time: the newest upload wins.

    ``per_hour`` keeps one row per station and hour instead, the one the weather fact would keep (newest upload,
    then latest reading), so that fact needs no second shuffle.
    """
    parsed = landed.parse_payload(raw, landed.WEATHER_PAYLOAD)
    item = landed.explode_payload(parsed, "raw_data", with_index=True)
    reading = {
        "temperature_c": "air_temp_celsius",
        "dew_point_c": "dew_point_celsius",
        "pressure_hpa": "sea_level_pressure_hpa",
        "wind_speed_ms": "wind_speed_mps",
    }
    records = item.select(
        "station_id",
        cal.to_ntz("item.timestamp").alias("timestamp"),
        *[F.col(f"item.raw_data.{field}").alias(name) for name, field in reading.items()],
        F.col("id").alias("source_id"),
        "file_name",
        F.col("uploaded_at").alias("source_uploaded_at"),
        "item_index",
    ).filter(F.col("timestamp").isNotNull())
    ties = ["file_name", "item_index", *reading]
    if per_hour:
        hours = records.withColumn("_hour", cal.start_of_hour("timestamp"))
        newest = latest_by(hours, ["station_id", "_hour"], ["source_uploaded_at", "source_id", "timestamp", *ties])
    else:
        newest = latest_by(records, ["station_id", "timestamp"], ["source_uploaded_at", "source_id", *ties])
    t = F.col("temperature_c")
    heating, cooling = degree_days(t)
    return newest.select(
        surrogate_key("station_id", "timestamp").alias("observation_id"),
        "station_id",
        "timestamp",
        F.to_date("timestamp").alias("date"),
        F.hour("timestamp").alias("hour_of_day"),
        F.month("timestamp").alias("month"),
        F.year("timestamp").alias("year"),
        *reading,
        (t <= 0).alias("is_freezing"),
        classify.temperature_category(t).alias("temperature_category"),
        heating.alias("heating_degree_c"),
        cooling.alias("cooling_degree_c"),
        t.isNull().alias("is_missing_temperature"),
        "source_id",
        "file_name",
        "source_uploaded_at",
    )


def stage_station_metadata(raw: DataFrame, lookup: DataFrame, state: str = fixed.STATE_NAME) -> DataFrame:
    """One row per station seen in the raw weather, with its years and, if known, its place."""
    seen = raw.groupBy("station_id").agg(
        F.min("year").alias("data_from_year"), F.max("year").alias("data_to_year")
    )
    known = F.col("known_station_name")
    return seen.join(lookup, "station_id", "left").select(
        "station_id",
        surrogate_key("station_id").alias("station_key"),
        F.split_part("station_id", F.lit("-"), F.lit(1)).alias("usaf_id"),
        F.split_part("station_id", F.lit("-"), F.lit(2)).alias("wban_id"),
        "latitude",
        "longitude",
        F.col("elevation").alias("elevation_m"),
        classify.county("latitude", "longitude").alias("county"),
        F.lit(state).alias("state"),
        F.lit(fixed.COUNTRY).alias("country"),
        "data_from_year",
        "data_to_year",
        F.coalesce(known, F.concat(F.lit("Weather Station "), "station_id")).alias("station_name"),
        classify.truth(known.contains("Airport")).alias("is_airport"),
        (F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).alias("has_coordinates"),
    )
