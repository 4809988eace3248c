"""Exact ranks and percentiles of groups of any size.

A group may hold most of all rows, so no group is sorted in one task. Equal values are first counted (combined before
the shuffle). The distinct values are then dealt into ranges whose bounds are drawn from the data, so that ranges hold
about equally many however close the values lie. A running sum over the ranges of a group, as many as there are tasks,
gives the rows before a range, and a running sum inside the range the rest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.tables import settle
from .joins import null_safe_join


def value_ranges(counted: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """``counted`` with ``_range``: never decreasing in the value within a group, NULL last.

    Spark draws the bounds from a sample of the rows. They are kept by writing the rows once: two readers of a plan
    could see two samples.
    """
    dealt = counted.repartitionByRange(*[F.col(c) for c in by], F.col(value).asc_nulls_last())
    return settle(dealt.withColumn("_range", F.spark_partition_id()), "ranges")


def value_ranks(df: DataFrame, by: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """One row per group and distinct value: ``rows_here``, ``rows_before`` (smaller values), ``rows_total``.

    NULL sorts last. With ``weight`` a row counts as that many rows, as if it had been repeated.
    """
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    ranged = value_ranges(df.groupBy(*by, value).agg(rows.alias("rows_here")), by, value)
    ranges = ranged.groupBy(*by, "_range").agg(F.sum("rows_here").alias("_range_rows"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        *by,
        "_range",
        F.coalesce(F.sum("_range_rows").over(earlier), F.lit(0)).alias("_before_range"),
        F.sum("_range_rows").over(group).alias("rows_total"),
    )
    inside = (
        Window.partitionBy(*by, "_range")
        .orderBy(F.col(value).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return null_safe_join(ranged, starts, [*by, "_range"]).select(
        *by,
        value,
        "rows_here",
        (F.col("_before_range") + F.coalesce(F.sum("rows_here").over(inside), F.lit(0))).alias("rows_before"),
        "rows_total",
    )


def percent_ranks(df: DataFrame, by: Sequence[str], value: str, output: str, weight: str | None = None) -> DataFrame:
    """``percent_rank`` of each distinct value of a group (ascending, NULL last)."""
    rank = F.when(F.col("rows_total") == 1, 0.0).otherwise(F.col("rows_before") / (F.col("rows_total") - 1))
    return value_ranks(df, by, value, weight).select(*by, value, rank.alias(output))


def percent_rank_by(df: DataFrame, by: Sequence[str], value: str, output: str) -> DataFrame:
    """Adds the percent rank of a value within its group to every row."""
    return null_safe_join(df, percent_ranks(df, by, value, output), [*by, value], "left")


def group_percentiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    percentiles: Mapping[str, float],
    exact: bool = True,
    accuracy: int = 10_000,
) -> DataFrame:
    """Percentiles of each group as columns named by ``percentiles``; NULL values are left out.

    Exact percentiles interpolate between the two neighbouring values. The approximate ones return a value that
    occurs, from a sketch whose size ``accuracy`` bounds.
    """
    present = df.filter(F.col(value).isNotNull())
    if not exact:
        return present.groupBy(*by).agg(
            *[F.percentile_approx(value, F.lit(p), F.lit(accuracy)).alias(name) for name, p in percentiles.items()]
        )
    ranks = value_ranks(present.select(*by, value), by, value)
    place = {name: F.lit(float(p)) * (F.col("rows_total") - 1) for name, p in percentiles.items()}

    def covers(rank: Column) -> Column:
        return (F.col("rows_before") <= rank) & (rank < F.col("rows_before") + F.col("rows_here"))

    wanted = F.lit(False)
    found = []
    for name, position in place.items():
        low, high = covers(F.floor(position)), covers(F.ceil(position))
        wanted = wanted | low | high
        found += [
            F.max(F.when(low, F.col(value))).alias(f"_low_{name}"),
            F.max(F.when(high, F.col(value))).alias(f"_high_{name}"),
            F.max(position - F.floor(position)).alias(f"_part_{name}"),
        ]
    picked = ranks.filter(wanted).groupBy(*by).agg(*found)
    return picked.select(
        *by,
        *[
            (F.col(f"_low_{name}") + (F.col(f"_high_{name}") - F.col(f"_low_{name}")) * F.col(f"_part_{name}")).alias(name)
            for name in percentiles
        ],
    )
