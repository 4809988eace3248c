"""Validity history of a dimension: versions that changes open and close, also when they arrive late."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .joins import drop_existing, null_safe_join


def changed_versions(
    history: DataFrame | None,
    changes: DataFrame,
    key: Sequence[str],
    attributes: Sequence[str],
    valid_from: str = "valid_from_date",
    valid_to: str = "valid_to_date",
) -> DataFrame:
    """All versions of the keys that ``changes`` name; the versions of other keys stay as they are.

    A change says that from ``valid_from`` on (NULL: since ever) the attributes are these, until the next recorded
    change. It closes the version valid before it the day before, and ends the day before the version after it,
    however late it arrives; one for a start that is held already corrects it. A change to what is valid anyway opens
    no version. ``changes`` has one row per key and start.
    """
    columns = [*key, *attributes, valid_from]
    rows = changes.select(*columns)
    if history is not None:
        theirs = null_safe_join(history.select(*columns), rows.select(*key).distinct(), key)
        rows = rows.unionByName(drop_existing(theirs, rows, [*key, valid_from], null_safe=True))
    series = Window.partitionBy(*key).orderBy(F.col(valid_from).asc_nulls_first())
    repeats = F.row_number().over(series) > 1
    for attribute in attributes:
        repeats = repeats & F.col(attribute).eqNullSafe(F.lag(attribute).over(series))
    opened = rows.withColumn("_repeats", repeats).filter(~F.col("_repeats")).drop("_repeats")
    return opened.withColumn(valid_to, F.date_sub(F.lead(valid_from).over(series), 1))


def merge_versions(history: DataFrame | None, changes: DataFrame, key: Sequence[str], attributes: Sequence[str], **names) -> DataFrame:
    """The whole history after the changes."""
    changed = changed_versions(history, changes, key, attributes, **names)
    if history is None:
        return changed
    return drop_existing(history.select(*changed.columns), changes, key, null_safe=True).unionByName(changed)
