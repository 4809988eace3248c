"""Hourly and monthly facts: full refresh, and the incremental form of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import calendar as cal, fixed_values as fixed
from ..functions.numeric import safe_div, wind_chill
from ..operators.dedup import latest_by
from ..operators.joins import drop_existing, validity_join
from ..operators.series import delta, pct_change, share_of_total, sliced
from ..operators.upsert import rewrite_reached
from ..sources.tables import settle
from ..sources.watermark import newer_than

# The business code stands beside the location key: places missing from the dimension have no key, and would
# otherwise be taken for one place.
DEMAND_KEYS = ["date_id", "hour_of_day", "location_id", "balancing_authority"]
WEATHER_KEYS = ["date_id", "hour_of_day", "station_id"]
GENERATION_KEYS = ["date_id", "location_id", "location_code", "energy_source_id", "sector_id"]
SALES_KEYS = ["date_id", "location_id", "state_id", "sector_id"]

DEMAND_SERIES = ["location_id", "balancing_authority"]
GENERATION_SERIES = ["location_id", "location_code", "energy_source_id", "sector_id"]
SALES_SERIES = ["sector_id", "location_id", "state_id"]


def month_cut(date: str = "date") -> Column:
    """Slice of an hourly series: at most 744 rows. Pass a finer ``cut`` for readings much denser than hourly."""
    return F.trunc(date, "month")


def _of_type(locations: DataFrame, location_type: str) -> DataFrame:
    return locations.filter(F.col("location_type") == location_type)


def demand_base(staged: DataFrame, locations: DataFrame) -> DataFrame:
    """Staged demand with its dimension keys."""
    keyed = validity_join(
        staged,
        _of_type(locations, fixed.AUTHORITY_TYPE),
        ("balancing_authority", "location_code"),
        "date",
        ["location_id"],
    )
    return keyed.select(
        cal.date_id("date").alias("date_id"),
        "hour_of_day",
        "location_id",
        "balancing_authority",
        "timestamp",
        "date",
        "day_part",
        "demand_mwh",
        "is_negative_demand",
        "source_id",
        "source_uploaded_at",
    )


def demand_changes(base: DataFrame, cut: Column | None = None) -> DataFrame:
    return sliced(
        base,
        DEMAND_SERIES,
        "timestamp",
        month_cut() if cut is None else cut,
        1,
        lambda w: {"hourly_demand_change_mwh": delta("demand_mwh", w)},
    )


def fact_demand(staged: DataFrame, locations: DataFrame, cut: Column | None = None) -> DataFrame:
    """Hourly demand per authority with the change to the hour before."""
    return demand_changes(demand_base(staged, locations), cut)


# Increments read and rewrite a target partitioned by month (hourly facts) or year (monthly facts); ``with_partition``
# adds that column before the first write.

HOURLY_PARTITION, MONTHLY_PARTITION = "fact_month", "fact_year"


def with_partition(df: DataFrame, date: str, hourly: bool = True) -> DataFrame:
    """Adds the partition column of a fact."""
    if hourly:
        return df.withColumn(HOURLY_PARTITION, F.trunc(date, "month"))
    return df.withColumn(MONTHLY_PARTITION, F.year(date))


def fact_demand_increment(
    target: DataFrame, staged: DataFrame, locations: DataFrame, counts: DataFrame | None = None
) -> DataFrame:
    """Rows to merge into the demand fact: uploads beyond its watermark, and the hour after each of them."""
    updates = demand_base(newer_than(staged, "source_uploaded_at", target), locations)
    return rewrite_reached(
        target,
        settle(with_partition(updates, "date"), "updates"),
        DEMAND_KEYS,
        DEMAND_SERIES,
        "timestamp",
        HOURLY_PARTITION,
        1,
        demand_changes,
        counts=counts,
        cut=month_cut(),
    )


def weather_base(staged: DataFrame, locations: DataFrame, hourly: bool = False) -> DataFrame:
    """Staged weather, one row per station and hour, with its dimension keys.

    ``hourly`` says that staging already kept one row per hour, which saves a shuffle.
    """
    one = staged
    if not hourly:
        one = latest_by(
            staged, ["date", "hour_of_day", "station_id"], ["source_uploaded_at", "source_id", "timestamp"]
        )
    keyed = validity_join(
        one, _of_type(locations, fixed.STATION_TYPE), ("station_id", "location_code"), "date", ["location_id"]
    )
    return keyed.select(
        cal.date_id("date").alias("date_id"),
        "hour_of_day",
        "station_id",
        "location_id",
        "timestamp",
        "date",
        "temperature_c",
        "dew_point_c",
        "pressure_hpa",
        "wind_speed_ms",
        "heating_degree_c",
        "cooling_degree_c",
        "temperature_category",
        "is_freezing",
        "source_id",
        "source_uploaded_at",
    )


def weather_changes(base: DataFrame, cut: Column | None = None) -> DataFrame:
    changed = sliced(
        base,
        ["station_id"],
        "timestamp",
        month_cut() if cut is None else cut,
        1,
        lambda w: {"hourly_temp_change_c": delta("temperature_c", w)},
    )
    return changed.withColumn("feels_like_temp_c", wind_chill("temperature_c", "wind_speed_ms"))


def fact_weather(
    staged: DataFrame, locations: DataFrame, hourly: bool = False, cut: Column | None = None
) -> DataFrame:
    """Hourly weather per station with the change to the hour before and the felt temperature."""
    return weather_changes(weather_base(staged, locations, hourly), cut)


def fact_weather_increment(
    target: DataFrame, staged: DataFrame, locations: DataFrame, counts: DataFrame | None = None
) -> DataFrame:
    """Rows to merge into the weather fact: new hours only (a held hour is never revised), and the hour after each."""
    fresh = newer_than(staged, "source_uploaded_at", target)
    fresh = drop_existing(fresh.withColumn("date_id", cal.date_id("date")), target, WEATHER_KEYS).drop("date_id")
    updates = settle(with_partition(weather_base(fresh, locations), "date"), "updates")
    return rewrite_reached(
        target,
        updates,
        WEATHER_KEYS,
        ["station_id"],
        "timestamp",
        HOURLY_PARTITION,
        1,
        weather_changes,
        counts=counts,
        cut=month_cut(),
    )


def generation_base(staged: DataFrame, sources: DataFrame, locations: DataFrame) -> DataFrame:
    """Staged generation with its dimension keys, newest record per period, location, fuel and sector."""
    states = _of_type(locations, fixed.STATE_TYPE).select("location_code", "location_id")
    fuels = sources.select("fuel_type_id", F.col("source_id").alias("energy_source_id"))
    newest = latest_by(
        staged,
        ["period", "location_code", "fuel_type_id", "sector_id"],
        ["source_timestamp", "source_id", "generation_mwh"],
    )
    return (
        newest.join(states, "location_code", "left")
        .join(fuels, "fuel_type_id", "left")
        .select(
            cal.date_id(F.trunc("generation_date", "month")).alias("date_id"),
            "location_id",
            "location_code",
            "energy_source_id",
            "sector_id",
            "period",
            "generation_date",
            "year",
            "month",
            "sector_name",
            "generation_mwh",
            "is_renewable",
            "is_fossil_fuel",
            F.col("source_id").alias("source_record_id"),
            F.col("source_timestamp").alias("source_uploaded_at"),
        )
    )


def generation_shares(base: DataFrame, exclude_from_total: tuple[str, ...] = ()) -> DataFrame:
    """Share of the month's total and change to the month before.

    A month of a location has one row per fuel and sector, and a series one row per month, so no window group
    grows with the data. Energy sources in ``exclude_from_total`` take no part in the total.
    """
    month = Window.partitionBy("date_id", "location_id", "location_code")
    series = Window.partitionBy(*GENERATION_SERIES).orderBy("generation_date")
    columns = {"monthly_generation_change_mwh": delta("generation_mwh", series)}
    if exclude_from_total:
        counted = F.when(~F.col("energy_source_id").isin(list(exclude_from_total)), F.col("generation_mwh"))
        columns["percentage_of_total"] = share_of_total(counted, month)
    else:
        columns["percentage_of_total"] = share_of_total("generation_mwh", month)
    return base.withColumns(columns)


def fact_generation(staged: DataFrame, sources: DataFrame, locations: DataFrame) -> DataFrame:
    """Monthly generation per location, fuel and sector."""
    return generation_shares(generation_base(staged, sources, locations))


def fact_generation_increment(
    target: DataFrame,
    staged: DataFrame,
    sources: DataFrame,
    locations: DataFrame,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Rows to merge into the generation fact: new keys only, the rows of their place and month (whose shares change),
    and the next month of each new row's series. Shares of that month need its whole place, so places are read whole."""
    fresh = generation_base(newer_than_upload(staged, target), sources, locations)
    updates = drop_existing(fresh, target, GENERATION_KEYS, null_safe=True)
    place = ["location_id", "location_code"]
    return rewrite_reached(
        target,
        settle(with_partition(updates, "generation_date", hourly=False), "updates"),
        GENERATION_KEYS,
        GENERATION_SERIES,
        "generation_date",
        MONTHLY_PARTITION,
        1,
        generation_shares,
        group=["date_id", *place],
        counts=counts,
        mates=place,
    )


def newer_than_upload(staged: DataFrame, target: DataFrame | None) -> DataFrame:
    return newer_than(staged, "source_timestamp", target, "source_uploaded_at")


def sales_base(staged: DataFrame, locations: DataFrame) -> DataFrame:
    """Staged sales with the location key, newest revision per period, state and sector."""
    newest = latest_by(
        staged,
        ["period", "state_id", "sector_id"],
        ["source_timestamp", "source_id", "sales_mwh", "revenue_usd", "price_cents_per_kwh", "customer_count"],
    )
    keyed = validity_join(
        newest, _of_type(locations, fixed.STATE_TYPE), ("state_id", "location_code"), "sales_date", ["location_id"]
    )
    return keyed.select(
        cal.date_id(F.trunc("sales_date", "month")).alias("date_id"),
        "location_id",
        "state_id",
        "sector_id",
        "period",
        "sales_date",
        "year",
        "month",
        "sales_mwh",
        "revenue_usd",
        "price_cents_per_kwh",
        "customer_count",
        F.col("source_id").alias("source_record_id"),
        F.col("source_timestamp").alias("source_uploaded_at"),
    )


def sales_changes(base: DataFrame) -> DataFrame:
    """Usage and revenue ratios, and the changes to 1 and 12 rows (months) before."""
    series = Window.partitionBy(*SALES_SERIES).orderBy("sales_date")
    return base.withColumns(
        {
            "avg_usage_per_customer_mwh": safe_div("sales_mwh", "customer_count"),
            "revenue_per_mwh_usd": safe_div("revenue_usd", "sales_mwh"),
            "yoy_sales_change_percent": pct_change("sales_mwh", series, 12),
            "mom_sales_change_percent": pct_change("sales_mwh", series, 1),
        }
    )


def fact_sales(staged: DataFrame, locations: DataFrame) -> DataFrame:
    """Monthly sales per location and sector."""
    return sales_changes(sales_base(staged, locations))


def fact_sales_increment(
    target: DataFrame, staged: DataFrame, locations: DataFrame, counts: DataFrame | None = None
) -> DataFrame:
    """Rows to merge into the sales fact: new keys only, and the twelve rows after each of them."""
    fresh = sales_base(newer_than_upload(staged, target), locations)
    updates = drop_existing(fresh, target, SALES_KEYS, null_safe=True)
    return rewrite_reached(
        target,
        settle(with_partition(updates, "sales_date", hourly=False), "updates"),
        SALES_KEYS,
        SALES_SERIES,
        "sales_date",
        MONTHLY_PARTITION,
        12,
        sales_changes,
        counts=counts,
    )
