"""Inline constant tables and the date spine."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import fixed_values as fixed


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Constant rows as a local relation: its size is known to the planner, and no Python worker is started.

    (Rows passed as a plain list would become a Python-made RDD of unknown size.)
    """
    names = [field.strip().split(" ")[0] for field in schema.split(",")]
    columns = zip(*rows) if rows else [[] for _ in names]
    table = pa.table({name: list(values) for name, values in zip(names, columns)})
    return spark.createDataFrame(table, schema)


def station_lookup(spark: SparkSession, rows: Sequence[tuple] = fixed.KNOWN_STATIONS) -> DataFrame:
    return inline_table(
        spark,
        rows,
        "station_id string, latitude double, longitude double, elevation int, known_station_name string",
    )


def population(spark: SparkSession, rows: Sequence[tuple] = fixed.POPULATION_MILLIONS) -> DataFrame:
    return inline_table(spark, rows, "location_code string, population_millions double")


def bridge_pairs(spark: SparkSession, rows: Sequence[tuple] = fixed.BRIDGE_PAIRS) -> DataFrame:
    return inline_table(spark, rows, "ba_code string, weather_station_name string")


def date_spine(spark: SparkSession, start: str, n: int) -> DataFrame:
    """``n`` consecutive dates. Generated in parallel, no global numbering."""
    return spark.range(n).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date"))


def spanning_spine(df: DataFrame, date: str) -> DataFrame:
    """Every day from the first to the last date of ``df``, gaps included."""
    span = df.agg(F.min(date).cast("date").alias("_first"), F.max(date).cast("date").alias("_last"))
    return span.select(F.explode(F.sequence("_first", "_last")).alias("date"))
