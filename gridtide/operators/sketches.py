"""Kept quantile sketches: one per group and part of the data, merged when percentiles are asked for.

A sketch has a bounded size however many values it has seen, and sketches of parts can be merged; so a refresh builds
anew those of the parts that changed only. Percentiles are values that occur, with a rank within the error below.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Size parameter of the sketches.
SKETCH_K = 200


def rank_error(k: int = SKETCH_K) -> float:
    """The share of the values by which a rank may be off, at 99 % confidence, as published for this kind of sketch."""
    return 2.296 / k**0.9723


def sketched_percentile(value: Column | str, p: float, k: int = SKETCH_K) -> Column:
    """Aggregate: an approximate percentile of the values of a group; NULL without one."""
    value = F.col(value) if isinstance(value, str) else value
    sketch = F.kll_sketch_agg_double(value.cast("double"), F.lit(k))
    return F.when(F.count(value) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(p)))


def quantile_sketches(df: DataFrame, by: Sequence[str], part: str, value: str, k: int = SKETCH_K) -> DataFrame:
    """(``by``, ``part``, ``sketch``, ``n``): one sketch of each group's values in each part; NULL values are left out."""
    present = df.filter(F.col(value).isNotNull())
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch")
    return present.groupBy(*by, part).agg(sketch, F.count(F.lit(1)).alias("n"))


def merged_percentiles(sketches: DataFrame, by: Sequence[str], percentiles: Mapping[str, float]) -> DataFrame:
    """Percentiles of each group as columns named by ``percentiles``, from the sketches of all its parts."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("_sketch"))
    columns = [F.kll_sketch_get_quantile_double("_sketch", F.lit(p)).alias(name) for name, p in percentiles.items()]
    return merged.select(*by, *columns)
