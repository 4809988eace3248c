"""Row-offset operators on time series, and a way to run them when one series is too long for one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..functions.keys import as_column
from ..functions.numeric import safe_div


def delta(value: Column | str, window: WindowSpec, k: int = 1) -> Column:
    """Difference to the row ``k`` back; NULL without one."""
    value = as_column(value)
    return value - F.lag(value, k).over(window)


def pct_change(value: Column | str, window: WindowSpec, k: int = 1) -> Column:
    """Change to the row ``k`` back in percent of it; NULL without one or when it is 0."""
    value = as_column(value)
    return safe_div(value - F.lag(value, k).over(window), F.lag(value, k).over(window)) * 100.0


def slope(value: Column | str, window: WindowSpec, k: int) -> Column:
    """Mean change per row over the last ``k`` rows."""
    return delta(value, window, k) / float(k)


def trailing_mean(value: Column | str, window: WindowSpec, n: int) -> Column:
    """Mean of the last ``n`` rows, the current one included."""
    return F.avg(as_column(value)).over(window.rowsBetween(1 - n, Window.currentRow))


def offset_mean(value: Column | str, window: WindowSpec, start: int, end: int) -> Column:
    """Mean of the rows from ``start`` to ``end`` back."""
    return F.avg(as_column(value)).over(window.rowsBetween(-start, -end))


def running_min(value: Column | str, window: WindowSpec, n: int) -> Column:
    return F.min(as_column(value)).over(window.rowsBetween(1 - n, Window.currentRow))


def conditional_ratio(value: Column | str, flag: Column | str, group: WindowSpec) -> Column:
    """Mean of the flagged rows of a group over the mean of its unflagged rows."""
    value, flag = as_column(value), as_column(flag)
    return safe_div(F.avg(F.when(flag, value)).over(group), F.avg(F.when(~flag, value)).over(group))


def share_of_total(value: Column | str, group: WindowSpec) -> Column:
    """Percent of the group's sum; 0 when that sum is not positive."""
    value = as_column(value)
    total = F.sum(value).over(group)
    return F.when(total > 0, value / total * 100.0).otherwise(0.0)


def sliced(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    cut: Column,
    reach: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
) -> DataFrame:
    """Adds window columns that look at most ``reach`` rows back in each series, without one task per series.

    ``cut`` is a coarse step of the order column (a month, a day): a series is spread over its slices. Rows at
    position ``reach`` or later of a slice are complete inside it. The others are computed again among the first
    and last ``reach`` rows of every slice, where they find the same predecessors as in the whole series. Both
    parts read one shuffle by (series, slice); only the slice edges are shuffled once more. The order must be
    unique within a series.
    """
    inside = Window.partitionBy(*by, "_cut").orderBy(order)
    across = Window.partitionBy(*by).orderBy(order)
    marked = df.withColumn("_cut", cut).select(
        "*",
        F.row_number().over(inside).alias("_position"),
        F.lead(F.lit(True), reach).over(inside).alias("_followed"),
    )
    head = F.col("_position") <= reach
    body = marked.withColumns(columns(inside)).filter(~head)
    edges = marked.filter(head | F.col("_followed").isNull()).withColumns(columns(across)).filter(head)
    return body.unionByName(edges).drop("_cut", "_position", "_followed")
