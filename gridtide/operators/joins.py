"""Joins. None carries a broadcast hint: the planner and AQE broadcast a side only below the size limit of the
session (``spark.sql.autoBroadcastJoinThreshold``), and split skewed partitions of a shuffled join otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed_values as fixed


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which NULL keys match each other. Key columns of the right side are dropped."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(renamed[f"_right_{key}"])
    return left.join(renamed, condition, how).drop(*[f"_right_{key}" for key in keys])


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that adds the columns of a lookup table; rows without a match keep NULL."""
    return df.join(table, list(keys), "left")


def validity_join(
    fact: DataFrame,
    dimension: DataFrame,
    key: tuple[str, str],
    date: str,
    keep: Sequence[str],
    valid_from: str = "valid_from_date",
    valid_to: str = "valid_to_date",
    bucket_days: int | None = None,
) -> DataFrame:
    """Left join to the dimension row that is valid on the fact's date; open bounds always hold.

    ``key`` is (fact column, dimension column). The equality drives a hash join, the date range filters it: fine for a
    few versions a key. For keys with very many versions pass ``bucket_days``: versions are then repeated in the
    stretches of so many days that they touch, clipped to the days of the facts, and key and stretch are both matched,
    so a fact meets the versions of its stretch only. Choose it about as long as a version is valid.
    """
    side = dimension.select(
        F.col(key[1]).alias("_key"),
        F.coalesce(F.col(valid_from), F.lit(fixed.VALID_FROM_OPEN).cast("date")).alias("_from"),
        F.coalesce(F.col(valid_to), F.lit(fixed.VALID_TO_OPEN).cast("date")).alias("_to"),
        *keep,
    )
    condition = (F.col(key[0]) == F.col("_key")) & F.col(date).between(F.col("_from"), F.col("_to"))
    if bucket_days is None:
        return fact.join(side, condition, "left").drop("_key", "_from", "_to")
    stretch = lambda day: F.floor(F.unix_date(F.to_date(day)) / bucket_days).cast("int")
    first, last = fact.agg(F.to_date(F.min(date)), F.to_date(F.max(date))).first()
    if first is None:  # no fact has a date
        return fact.join(side.limit(0), condition, "left").drop("_key", "_from", "_to")
    begin, end = F.greatest("_from", F.lit(first)), F.least("_to", F.lit(last))
    touched = side.filter(begin <= end).withColumn("_stretch", F.explode(F.sequence(stretch(begin), stretch(end))))
    marked = fact.withColumn("_in", stretch(F.col(date)))
    met = marked.join(touched, condition & (F.col("_in") == F.col("_stretch")), "left")
    return met.drop("_key", "_from", "_to", "_in", "_stretch")


def prior_period_join(
    df: DataFrame,
    keys: Sequence[str],
    year: str,
    values: Sequence[str],
    prefix: str = "previous_year_",
    lag_years: int = 1,
) -> DataFrame:
    """Adds the ``values`` of the row with the same keys ``lag_years`` earlier (left; shifted key, so equi)."""
    previous = df.select(*keys, (F.col(year) + lag_years).alias(year), *[F.col(v).alias(prefix + v) for v in values])
    return df.join(previous, [*keys, year], "left")


def build_bridge(locations: DataFrame, pairs: DataFrame) -> DataFrame:
    """Authority-to-station pairs of the same state, from wanted (authority code, station name) pairs.

    Two equi joins through the pair list instead of a cross product of all locations.
    """
    authorities = locations.filter(F.col("location_type") == fixed.AUTHORITY_TYPE).select(
        F.col("location_id").alias("balancing_authority_id"),
        F.col("city").alias("balancing_authority_name"),
        F.col("location_code").alias("ba_code"),
        "state_name",
    )
    stations = locations.filter(
        (F.col("location_type") == fixed.STATION_TYPE) & F.col("latitude").isNotNull()
    ).select(
        F.col("location_id").alias("weather_station_id"),
        F.col("city").alias("weather_station_name"),
        F.col("latitude").alias("weather_station_lat"),
        F.col("longitude").alias("weather_station_long"),
        "state_name",
    )
    return (
        authorities.join(pairs.distinct(), "ba_code")
        .join(stations, ["weather_station_name", "state_name"])
        .select(
            "balancing_authority_id",
            "balancing_authority_name",
            "ba_code",
            "weather_station_id",
            "weather_station_name",
            "weather_station_lat",
            "weather_station_long",
        )
    )


def bridge_first(
    fact: DataFrame,
    bridge: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    order: Sequence[str],
    keep: Sequence[str],
    fact_key: str = "location_id",
    other_key: str = "location_id",
    count: str = "readings",
    few: bool = False,
) -> DataFrame:
    """Each fact row with columns ``keep`` of the first row, by ``order``, that ``other`` has for its stations and ``on``.

    ``count`` says how many rows there were, and 1 without any: the rows a plain join through the bridge would give.
    ``other`` is reduced to one row per fact key before it meets the facts, so no fact row is ever repeated. With
    ``few`` facts, ``other`` is first cut down to their keys. ``order`` should be total; its NULLs come first.
    """
    hop = bridge.select(F.col("balancing_authority_id").alias("_fact"), F.col("weather_station_id").alias("_other"))
    near = other.withColumnRenamed(other_key, "_other").join(hop, "_other").withColumnRenamed("_fact", fact_key)
    key = [fact_key, *on]
    if few:
        near = near.join(fact.select(*key).distinct(), key, "left_semi")
    first = near.groupBy(*key).agg(F.min(F.struct(*order, *keep)).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    met = fact.join(first, key, "left")
    return met.select(*fact.columns, *[F.col(f"_first.{c}").alias(c) for c in keep], F.coalesce("_rows", F.lit(1)).alias(count))


def drop_existing(df: DataFrame, target: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows whose keys the target does not hold yet. With plain equality a NULL key never counts as held."""
    held = target.select(*keys)
    if null_safe:
        renamed = held.withColumnsRenamed({key: f"_right_{key}" for key in keys})
        condition = F.lit(True)
        for key in keys:
            condition = condition & df[key].eqNullSafe(renamed[f"_right_{key}"])
        return df.join(renamed, condition, "left_anti")
    return df.join(held, list(keys), "left_anti")
