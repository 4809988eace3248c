"""Generation mix, weather–demand correlation, peak drivers and cumulative patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import calendar as cal, classify, fixed_values as fixed
from ..functions.keys import surrogate_key
from ..functions.numeric import safe_div
from ..operators import series, stats
from ..operators.dedup import dominant
from ..operators.joins import bridge_first, null_safe_join, prior_period_join
from ..operators.ranks import group_percentiles, percent_ranks
from ..operators.sketches import merged_percentiles, quantile_sketches, sketched_percentile
from ..operators.upsert import initial_bound, rewrite_reached
from ..sources.tables import settle
from .facts import MONTHLY_PARTITION, with_partition

# An authority without a location key is still a series of its own, told by its code.
CUMULATIVE_SERIES = ["balancing_authority_id", "balancing_authority"]
CUMULATIVE_KEYS = [*CUMULATIVE_SERIES, "date_id"]
PROFILE_KEYS = ["location_id", "season", "hour_of_day"]
CUMULATIVE_REACH = fixed.INITIAL_LOAD_DAYS - 1


# Generation mix


def monthly_generation(facts: DataFrame, dates: DataFrame, sources: DataFrame) -> DataFrame:
    """Generation facts with calendar and fuel attributes."""
    calendar = dates.select(
        "date_id", F.col("month_number").alias("month"), "year", "month_name", "quarter", "season"
    )
    fuels = sources.select(
        F.col("source_id").alias("energy_source_id"),
        "fuel_type_id",
        "fuel_type_name",
        "primary_category",
        "is_renewable",
        "is_fossil_fuel",
        "is_nuclear",
    )
    measures = facts.select(
        "date_id", "location_id", "energy_source_id", "sector_id", "generation_mwh", "percentage_of_total"
    )
    return measures.join(calendar, "date_id").join(fuels, "energy_source_id")


def generation_mix(monthly: DataFrame, match_sector: bool = True) -> DataFrame:
    """Per month, location, source and sector: renewable share, change to the year before, dominant source, CO2.

    Without ``match_sector`` the source of a row, all its sectors together, is compared with itself a year before; the
    sums of a month and source meet once, however many sectors there are.
    """
    month = monthly.groupBy("date_id", "location_id").agg(
        stats.share("is_renewable", "generation_mwh").alias("renewable_percentage"),
        *dominant(
            "generation_mwh",
            {
                "dominant_source_name": "fuel_type_name",
                "dominant_source_id": "fuel_type_id",
                "dominant_category": "primary_category",
            },
            ["fuel_type_id", "sector_id"],
        ).values(),
    )
    measures = ["generation_mwh", "percentage_of_total"]
    source = ["location_id", "energy_source_id", "month"]
    if match_sector:
        compared = prior_period_join(monthly, [*source, "sector_id"], "year", measures).withColumns(
            {"_mwh": F.col("generation_mwh"), "_percentage": F.col("percentage_of_total")}
        )
    else:
        sums = monthly.groupBy(*source, "year").agg(*[F.sum(m).alias(m) for m in measures])
        yearly = prior_period_join(sums, source, "year", measures).withColumnsRenamed(
            {"generation_mwh": "_mwh", "percentage_of_total": "_percentage"}
        )
        compared = monthly.join(yearly, [*source, "year"])
    previous, previous_share = F.col("previous_year_generation_mwh"), F.col("previous_year_percentage_of_total")
    return compared.join(month, ["date_id", "location_id"]).select(
        "date_id",
        "location_id",
        "energy_source_id",
        "sector_id",
        "year",
        "month",
        "month_name",
        "quarter",
        "season",
        "fuel_type_id",
        "fuel_type_name",
        "primary_category",
        "is_renewable",
        "is_fossil_fuel",
        "is_nuclear",
        "generation_mwh",
        "percentage_of_total",
        "renewable_percentage",
        "previous_year_generation_mwh",
        previous_share.alias("previous_year_percentage"),
        (F.col("_mwh") - F.coalesce(previous, F.lit(0.0))).alias("yoy_change_mwh"),
        (F.col("_percentage") - F.coalesce(previous_share, F.lit(0.0))).alias("yoy_change_percentage"),
        classify.truth(F.col("fuel_type_id") == F.col("dominant_source_id")).alias("is_dominant_source"),
        "dominant_source_name",
        "dominant_source_id",
        "dominant_category",
        (F.col("generation_mwh") * classify.emission_factor("fuel_type_id")).alias("estimated_co2_emissions_tons"),
    )


# Weather–demand correlation


def daily_demand_weather(demand: DataFrame, weather: DataFrame, dates: DataFrame, bridge: DataFrame) -> DataFrame:
    """One row per authority and day: demand totals and the mean weather of the authority's stations."""
    days = stats.daily_rollup(demand, ["date_id", "location_id", "date"], "demand_mwh").select(
        "date_id",
        "date",
        F.col("location_id").alias("balancing_authority_id"),
        F.col("total").alias("daily_demand_mwh"),
        F.col("mean").alias("avg_hourly_demand_mwh"),
        F.col("peak").alias("peak_demand_mwh"),
    )
    stations = stats.weather_rollup(weather, ["date_id", "station_id", "location_id", "date"])
    hop = bridge.select("balancing_authority_id", F.col("weather_station_id").alias("location_id"))
    outputs = {
        "regional_avg_temp_c": "avg_temp_c",
        "regional_max_temp_c": "max_temp_c",
        "regional_min_temp_c": "min_temp_c",
        "regional_temp_range_c": "temp_range_c",
        "regional_hdd_c": "heating_degree_day_c",
        "regional_cdd_c": "cooling_degree_day_c",
        "regional_avg_wind_ms": "avg_wind_speed_ms",
    }
    # Averaged per authority before it meets demand: the demand rows are never multiplied by their stations.
    regional = (
        stations.join(hop, "location_id")
        .groupBy("balancing_authority_id", "date_id")
        .agg(*[F.avg(column).alias(name) for name, column in outputs.items()])
    )
    calendar = dates.select("date_id", "is_weekend", "is_holiday", "season")
    return days.join(calendar, "date_id").join(regional, ["balancing_authority_id", "date_id"], "left")


SEASON_THRESHOLDS = {"high_temp_threshold": fixed.EXTREME_HOT_RANK, "low_temp_threshold": fixed.EXTREME_COLD_RANK}


def season_sketches(daily: DataFrame) -> DataFrame:
    """Temperature sketches per authority, season and month, to be kept; the month is the part a refresh replaces."""
    month = F.trunc("date", "month").alias("sketch_month")
    days = daily.select("balancing_authority_id", "season", month, "regional_avg_temp_c")
    return quantile_sketches(days, ["balancing_authority_id", "season"], "sketch_month", "regional_avg_temp_c")


def season_thresholds(sketches: DataFrame) -> DataFrame:
    """Thresholds of each authority and season from its kept sketches."""
    return merged_percentiles(sketches, ["balancing_authority_id", "season"], SEASON_THRESHOLDS)


def weather_demand_correlation(
    daily: DataFrame, locations: DataFrame, exact_thresholds: bool = False, thresholds: DataFrame | None = None
) -> DataFrame:
    """Daily rows with their season's temperature sensitivity, expected demand, anomaly and weekend ratio.

    All group metrics come from one aggregation per authority and season. The thresholds of the temperature zones are
    approximate unless ``exact_thresholds`` (a group has one row per day, so that stays small as well); pass those of
    :func:`season_thresholds` to use kept sketches.
    """
    t, d = F.col("regional_avg_temp_c"), F.col("daily_demand_mwh")
    percentile = (lambda v, p: F.percentile(v, F.lit(p))) if exact_thresholds else sketched_percentile
    own = [] if thresholds is not None else [percentile(t, p).alias(name) for name, p in SEASON_THRESHOLDS.items()]
    weekday = F.when(~F.col("is_weekend"), d)
    seasons = daily.groupBy("balancing_authority_id", "season").agg(
        *stats.sensitivity(t, d),
        *stats.band_means(t, d),
        *own,
        F.sum(d).alias("_sum"),
        F.count(d).alias("_n"),
        F.sum(weekday).alias("_weekday_sum"),
        F.count(weekday).alias("_weekday_n"),
    )
    if thresholds is not None:
        seasons = seasons.join(thresholds, ["balancing_authority_id", "season"], "left")
    authority = Window.partitionBy("balancing_authority_id")
    metrics = seasons.withColumns(
        {
            "_mean": safe_div(F.sum("_sum").over(authority), F.sum("_n").over(authority)),
            "_weekday_mean": safe_div(F.sum("_weekday_sum").over(authority), F.sum("_weekday_n").over(authority)),
        }
    )
    names = locations.select(
        F.col("location_id").alias("balancing_authority_id"), F.col("city").alias("balancing_authority_name")
    )
    expected, anomaly = stats.expected_and_anomaly(d, t, "temp_sensitivity_mwh_per_degree", "_mean")
    zone = classify.bucket(
        [(t > F.col("high_temp_threshold"), "HIGH_TEMP_ZONE"), (t < F.col("low_temp_threshold"), "LOW_TEMP_ZONE")],
        "NORMAL_TEMP_ZONE",
    )
    joined = daily.join(metrics, ["balancing_authority_id", "season"]).join(names, "balancing_authority_id")
    return joined.select(
        "date_id",
        "date",
        "balancing_authority_id",
        "balancing_authority_name",
        "daily_demand_mwh",
        "peak_demand_mwh",
        "regional_avg_temp_c",
        "regional_max_temp_c",
        "regional_min_temp_c",
        "regional_hdd_c",
        "regional_cdd_c",
        "season",
        "is_weekend",
        "is_holiday",
        "temp_demand_correlation",
        "temp_sensitivity_mwh_per_degree",
        "hot_weather_avg_demand",
        "mild_weather_avg_demand",
        "cold_weather_avg_demand",
        expected.alias("temperature_expected_demand"),
        anomaly.alias("demand_anomaly_mwh"),
        zone.alias("temperature_zone"),
        stats.weekend_ratio(d, "is_weekend", "_weekday_mean").alias("weekend_demand_ratio"),
    )


# Peak demand drivers


def demand_with_weather(
    demand: DataFrame, weather: DataFrame, dates: DataFrame, locations: DataFrame, bridge: DataFrame
) -> DataFrame:
    """Hourly demand with calendar, location name and the first reading of the authority's stations in that hour.

    ``readings`` counts the rows that joining all readings would give; ranks weigh an hour by it.
    """
    facts = demand.select("date_id", "hour_of_day", "location_id", "timestamp", "demand_mwh")
    calendar = dates.select("date_id", "season", "is_weekend", "is_holiday")
    names = locations.select("location_id", F.col("city").alias("location_name"))
    described = facts.join(calendar, "date_id").join(names, "location_id")
    measures = ["temperature_c", "dew_point_c", "pressure_hpa", "wind_speed_ms"]
    readings = weather.withColumnRenamed("timestamp", "weather_timestamp")
    return bridge_first(
        described, bridge, readings, ["date_id", "hour_of_day"], ["weather_timestamp", "station_id"], measures
    )


def mark_peaks(hours: DataFrame, weather: DataFrame) -> DataFrame:
    """Demand hours with percent rank, peak flag and temperature zone. The rank counts an hour once per reading."""
    extremes = group_percentiles(
        weather, [], "temperature_c", {"hot": fixed.EXTREME_HOT_RANK, "cold": fixed.EXTREME_COLD_RANK}
    )
    bounds = extremes.select(F.struct("hot", "cold")).scalar()
    t = F.col("temperature_c")
    zone = classify.bucket(
        [(t > bounds.getField("hot"), "EXTREME_HOT"), (t < bounds.getField("cold"), "EXTREME_COLD")], "NORMAL"
    )
    group = ["location_id"]
    ranks = percent_ranks(hours, group, "demand_mwh", "demand_percentile", "readings")
    ranked = null_safe_join(hours, ranks, [*group, "demand_mwh"], "left")
    date = cal.date_from_id("date_id")
    return ranked.select(
        "*",
        date.alias("date"),
        F.dayname(date).alias("day_name"),
        classify.truth(F.col("demand_percentile") >= fixed.PEAK_RANK).alias("is_peak_hour"),
        zone.alias("temperature_zone"),
    )


def demand_profile(hours: DataFrame) -> DataFrame:
    """One row per authority, season and hour of day: temperature sensitivity and every baseline of demand.

    One aggregation holds all of them; the season-wide means are rolled up from its (at most 24) rows per season.
    """
    d, t = F.col("demand_mwh"), F.col("temperature_c")
    weekend = F.col("is_weekend")
    profile = hours.groupBy(*PROFILE_KEYS).agg(
        *stats.sensitivity(t, d),
        F.avg(F.when(weekend, d)).alias("_weekend_mean"),
        F.avg(F.when(~weekend, d)).alias("_weekday_mean"),
        F.sum(d).alias("_sum"),
        F.count(d).alias("_n"),
        F.sum(t).alias("_sum_t"),
        F.count(t).alias("_n_t"),
    )
    season = Window.partitionBy("location_id", "season")
    return profile.withColumns(
        {
            "_season_mean": safe_div(F.sum("_sum").over(season), F.sum("_n").over(season)),
            "_season_mean_t": safe_div(F.sum("_sum_t").over(season), F.sum("_n_t").over(season)),
        }
    )


def peak_drivers(hours: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Marked demand hours with their seasonal baseline and the parts that weather, weekend and time of day explain.

    Pass the settled ``demand_profile`` on large data: its size is then known before the join is planned, and the
    hours need not be shuffled to meet it.
    """
    profile = demand_profile(hours) if profile is None else profile
    d, t, weekend = F.col("demand_mwh"), F.col("temperature_c"), F.col("is_weekend")
    parts = stats.decompose(
        d, t, "_season_mean_t", "temp_sensitivity_mwh_per_degree", weekend, "_weekday_mean", "_season_mean"
    )
    return (
        hours.join(profile, PROFILE_KEYS)
        .withColumns(parts)
        .select(
            surrogate_key("date_id", "hour_of_day", "location_id").alias("peak_driver_id"),
            "date_id",
            "hour_of_day",
            "location_id",
            "location_name",
            "timestamp",
            "date",
            "day_name",
            "season",
            "is_weekend",
            "is_holiday",
            "demand_mwh",
            "demand_percentile",
            "is_peak_hour",
            F.when(weekend, F.col("_weekend_mean")).otherwise(F.col("_weekday_mean")).alias("seasonal_baseline_mwh"),
            "temperature_c",
            "temperature_zone",
            "temp_demand_correlation",
            *parts,
        )
    )


# Cumulative demand patterns


def daily_demand(demand: DataFrame, dates: DataFrame, as_of: str | None = None) -> DataFrame:
    """Daily demand per authority with calendar attributes; with ``as_of`` only the two years before it."""
    days = stats.daily_rollup(demand, ["location_id", "balancing_authority", "date_id"], "demand_mwh").select(
        F.col("location_id").alias("balancing_authority_id"),
        "balancing_authority",
        "date_id",
        F.col("total").alias("daily_demand_mwh"),
        F.col("peak").alias("daily_peak_demand_mwh"),
        F.col("mean").alias("daily_avg_demand_mwh"),
        F.col("deviation").alias("daily_demand_variability"),
    )
    calendar = dates.select(
        "date_id", "date", "day_of_week", "month_number", "quarter", "is_weekend", "season", "year", "week_of_year"
    )
    if as_of is not None:
        calendar = initial_bound(calendar, "date", as_of, fixed.INITIAL_LOAD_DAYS)
    return days.join(calendar, "date_id")


def cumulative_columns(daily: DataFrame) -> DataFrame:
    """Trailing means and changes. A series has one row per day, so its window is bounded by the calendar."""
    w = Window.partitionBy(*CUMULATIVE_SERIES).orderBy("date")
    week = Window.partitionBy(*CUMULATIVE_SERIES, "year", "week_of_year")
    v = "daily_demand_mwh"
    return daily.withColumns(
        {
            "trailing_7d_avg_demand": series.trailing_mean(v, w, 7),
            "trailing_30d_avg_demand": series.trailing_mean(v, w, 30),
            "trailing_90d_avg_demand": series.trailing_mean(v, w, 90),
            "quarter_over_quarter_pct_change": series.pct_change(v, w, 90),
            "month_over_month_pct_change": series.pct_change(v, w, 30),
            "current_week_avg": series.trailing_mean(v, w, 7),
            "previous_week_avg": series.offset_mean(v, w, 13, 7),
            "daily_demand_trend_per_day": series.slope(v, w, 7),
            "weekend_weekday_ratio": series.conditional_ratio(v, "is_weekend", week),
            "first_date_in_window": series.running_min("date", w, fixed.INITIAL_LOAD_DAYS),
        }
    )


def cumulative_patterns(demand: DataFrame, dates: DataFrame, as_of: str | None = None) -> DataFrame:
    """Daily demand per authority with trailing means, period changes, trend and weekly pattern."""
    return cumulative_columns(daily_demand(demand, dates, as_of)).drop("year", "week_of_year")


def cumulative_table(demand: DataFrame, dates: DataFrame, as_of: str | None = None) -> DataFrame:
    """The patterns as they are stored for later increments: with the week of each day, and partitioned by year."""
    return with_partition(cumulative_columns(daily_demand(demand, dates, as_of)), "date", hourly=False)


def cumulative_increment(
    target: DataFrame,
    demand: DataFrame,
    dates: DataFrame,
    changed_days: DataFrame,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Rows to merge into the cumulative table after the demand of some days changed.

    ``changed_days`` holds (location_id, balancing_authority, date_id). Rewritten are the days that look back to a
    changed one and those of its calendar week, which the turn of the year may split; it lies in one year's partition.
    """
    key = ["location_id", "balancing_authority", "date_id"]
    days = settle(changed_days.select(*key).distinct(), "changed-days")
    updates = daily_demand(null_safe_join(demand, days, key), dates)
    updates = settle(with_partition(updates, "date", hourly=False), "updates")
    return rewrite_reached(
        target,
        updates,
        CUMULATIVE_KEYS,
        CUMULATIVE_SERIES,
        "date",
        MONTHLY_PARTITION,
        CUMULATIVE_REACH,
        cumulative_columns,
        group=[*CUMULATIVE_SERIES, "year", "week_of_year"],
        counts=counts,
    )
