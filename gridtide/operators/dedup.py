"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # The filter on row_number() = 1 becomes a group limit that runs before the shuffle as well: a key with very
    # many copies sends one row per map task, not all its copies to one task.
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).filter(F.col("_position") == 1).drop("_position")


def latest_by(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order_desc``; NULL counts as highest. The order should be total."""
    return _first_row(df, keys, [F.col(c).desc_nulls_first() for c in order_desc])


def first_by(df: DataFrame, keys: Sequence[str], order_asc: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order_asc``; NULL counts as highest. The order should be total."""
    return _first_row(df, keys, [F.col(c).asc_nulls_last() for c in order_asc])


def dominant(value: str, carry: dict[str, str], tie: Sequence[str]) -> dict[str, Column]:
    """Aggregates that pick columns of the row with the largest ``value`` of a group, for use in ``agg``.

    ``carry`` maps output name to column. NULL counts as largest; equal values are decided by ``tie``, highest first.
    """
    order = F.struct(F.col(value).isNull(), F.col(value), *[F.col(c) for c in tie])
    return {output: F.max_by(F.col(column), order).alias(output) for output, column in carry.items()}


def number_rows(df: DataFrame, order: str, output: str, prefix: int = 2) -> DataFrame:
    """Global row numbers 1, 2, … by a unique text column, without sending all rows to one task.

    Rows are numbered inside cells of equal leading characters; a cell starts after the rows of earlier cells.
    Only the per-cell counts, as many as there are prefixes, pass through one task.
    """
    cell = F.coalesce(F.substring(F.col(order), 1, prefix), F.lit(""))
    placed = df.withColumn("_cell", cell).withColumn("_no_value", F.col(order).isNull())
    counts = placed.groupBy("_no_value", "_cell").agg(F.count(F.lit(1)).alias("_rows"))
    cells_in_order = Window.orderBy("_no_value", "_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_no_value", "_cell", F.coalesce(F.sum("_rows").over(cells_in_order), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_no_value", "_cell").orderBy(order)
    return (
        placed.join(starts, ["_no_value", "_cell"])
        .withColumn(output, F.col("_start") + F.row_number().over(inside))
        .drop("_no_value", "_cell", "_start")
    )
