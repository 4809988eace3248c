"""Merges of new rows into a table, as DataFrames. Parquet has no MERGE, so a merge is an anti join and a union."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..sources.tables import settle
from .joins import drop_existing, null_safe_join
from .series import sliced

ON_SCHEMA_CHANGE = ("append", "sync", "ignore", "fail")


def fit_schema(target: DataFrame, updates: DataFrame, on_schema_change: str = "append") -> tuple[DataFrame, DataFrame]:
    """Both sides with the merged table's columns.

    ``append`` keeps old columns and adds new ones, ``sync`` takes exactly the new columns, ``ignore`` keeps
    exactly the old ones, ``fail`` refuses a difference. Missing columns are NULL of the right type.
    """
    if on_schema_change not in ON_SCHEMA_CHANGE:
        raise ValueError(f"on_schema_change must be one of {ON_SCHEMA_CHANGE}")
    old, new = set(target.columns), set(updates.columns)
    if on_schema_change == "fail" and old != new:
        raise ValueError(f"columns differ: {sorted(old ^ new)}")
    if on_schema_change == "sync":
        columns = updates.columns
    elif on_schema_change == "append":
        columns = target.columns + [c for c in updates.columns if c not in old]
    else:
        columns = target.columns
    types = {f.name: f.dataType for f in [*target.schema.fields, *updates.schema.fields]}

    def shaped(df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return df.select(*[F.col(c) if c in have else F.lit(None).cast(types[c]).alias(c) for c in columns])

    return shaped(target), shaped(updates)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], on_schema_change: str = "append") -> DataFrame:
    """The table after updating matched and inserting new rows. Keys are unique in ``updates``; NULL keys match."""
    target, updates = fit_schema(target, updates, on_schema_change)
    return drop_existing(target, updates, keys, null_safe=True).unionByName(updates)


def insert_only(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], on_schema_change: str = "append"
) -> DataFrame:
    """The table after inserting rows with new keys; the first write of a key stays."""
    target, updates = fit_schema(target, updates, on_schema_change)
    return target.unionByName(drop_existing(updates, target, keys))


def initial_bound(df: DataFrame, date: str, as_of: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``."""
    return df.filter(F.col(date) >= F.date_sub(F.lit(as_of).cast("date"), days))


def partition_counts(target: DataFrame, by: Sequence[str], partition: str) -> DataFrame:
    """Rows of every series in every partition; of the target only the key columns are read."""
    return target.groupBy(*by, partition).agg(F.count(F.lit(1)).alias("rows_held"))


def reached_partitions(
    counts: DataFrame, changed: DataFrame, by: Sequence[str], partition: str, reach: int, mates: Sequence[str] = ()
) -> DataFrame:
    """(``by``, ``partition``) of all rows needed to derive again what changes reach, found from row counts alone.

    A changed row reaches the ``reach`` rows after it in its series, and each of those looks ``reach`` rows back.
    ``counts`` are those of :func:`partition_counts`; ``changed`` names the series and partitions with changes. With
    ``mates``, columns out of ``by``, a change in a partition changes all series of these columns there.

    A partition is needed if fewer than ``reach`` rows lie between it and a changed one, on either side. Two running
    extremes over the partitions of a series say so; rows between changes that lie apart are never read.
    """
    known = counts.select(*by, partition, "rows_held", F.lit(False).alias("_changed"))
    new = changed.select(*by, partition).distinct()
    new = new.select("*", F.lit(0).cast("long").alias("rows_held"), F.lit(True).alias("_changed"))
    both = known.unionByName(new).groupBy(*by, partition)
    marked = both.agg(F.sum("rows_held").alias("rows_held"), F.max("_changed").alias("_changed"))
    if mates:
        marked = marked.withColumn("_changed", F.max("_changed").over(Window.partitionBy(*mates, partition)))
    series = Window.partitionBy(*by).orderBy(partition)
    before = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = series.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    placed = marked.withColumn("_end", F.sum("rows_held").over(before))
    placed = placed.withColumn("_begin", F.col("_end") - F.col("rows_held"))
    spans = placed.withColumns(
        {
            "_last_end": F.max(F.when(F.col("_changed"), F.col("_end"))).over(before),
            "_next_begin": F.min(F.when(F.col("_changed"), F.col("_begin"))).over(after),
        }
    )
    needed = (
        F.col("_changed")
        | (F.col("_begin") < F.col("_last_end") + reach)
        | (F.col("_end") > F.col("_next_begin") - reach)
    )
    return spans.filter(F.coalesce(needed, F.lit(False))).select(*by, partition)


def rewrite_reached(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    order: str,
    partition: str,
    reach: int,
    derive: Callable[[DataFrame], DataFrame],
    group: Sequence[str] = (),
    counts: DataFrame | None = None,
    mates: Sequence[str] = (),
    cut: Column | None = None,
) -> DataFrame:
    """The rows whose derived columns can change through ``updates``, derived anew: input for :func:`upsert`.

    ``updates`` holds base columns only, and ``derive`` adds the columns that look up to ``reach`` rows back in the
    series ``by`` or at the rows of a ``group``. Rewritten are the updates, the ``reach`` rows after each of them in
    its series, and the rows of its group; nothing else, however long the series go on. Read are the partitions of
    :func:`reached_partitions`, by literal values, so that a target partitioned by ``partition`` opens only those.

    A group lies in one partition; for one that crosses series pass ``mates``, the columns out of ``by`` they share.
    Pass ``cut``, a coarse step of the order, where a series is too long for one task.
    """
    base = updates.columns
    counts = partition_counts(target, by, partition) if counts is None else counts
    needed = settle(reached_partitions(counts, updates, by, partition, reach, mates), "needed")
    # as many values as there are partitions of the table, which the calendar bounds
    values = [r[0] for r in needed.select(partition).distinct().collect()]
    opened = target.filter(F.col(partition).isin(values)).select(*base)
    place = [*(mates or by), partition]
    held = null_safe_join(opened, needed.select(*place).distinct(), place)
    merged = drop_existing(held, updates, keys, null_safe=True).withColumn("_changed", F.lit(False))
    merged = merged.unionByName(updates.withColumn("_changed", F.lit(True)))

    def touched(w: WindowSpec) -> dict[str, Column]:
        return {"_touched": F.max("_changed").over(w.rowsBetween(-reach, Window.currentRow))}

    if cut is None:
        marked = merged.withColumns(touched(Window.partitionBy(*by).orderBy(order)))
    else:
        marked = sliced(merged, by, order, cut, reach, touched)
    if group:
        mate = F.max("_changed").over(Window.partitionBy(*group))
        marked = marked.withColumn("_touched", F.col("_touched") | mate)
    return derive(marked.drop("_changed")).filter("_touched").drop("_touched")
