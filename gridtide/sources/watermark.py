"""High watermarks of what has been loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """A catalog table, or None before its first load."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def max_event_time(records: DataFrame, value: Column | str, default: object = None) -> DataFrame:
    """Latest event time inside exploded payload records: one row, column ``latest``."""
    value = F.col(value) if isinstance(value, str) else value
    latest = F.max(value)
    return records.agg((latest if default is None else F.coalesce(latest, F.lit(default))).alias("latest"))


def watermark(df: DataFrame | None, column: str, default: object = None) -> object:
    """Maximum of a column as a plain value (one row reaches the driver), so it can prune partitions."""
    if df is None:
        return default
    value = df.agg(F.max(column)).first()[0]
    return default if value is None else value


def newer_than(df: DataFrame, column: str, target: DataFrame | None, target_column: str | None = None) -> DataFrame:
    """Rows beyond the target's watermark; everything while the target is missing or empty."""
    mark = watermark(target, target_column or column)
    if mark is None:
        return df
    return df.filter(F.col(column) > F.lit(mark).cast(df.schema[column].dataType))
