"""Data-quality checks that return the violating rows, and a one-scan count of many column checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def violations_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Keys with NULL are ignored."""
    present = df.dropna(how="any", subset=list(columns))
    return present.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def violations_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def violations_accepted(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Rows with a value outside the list; NULL is accepted."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def violations_fk(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose value does not occur in the parent; NULL is accepted."""
    known = parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull())
    return df.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def run_checks(
    model: str,
    df: DataFrame,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[object]] | None = None,
    unique: Sequence[str] = (),
    foreign: Sequence[tuple[str, DataFrame, str]] = (),
) -> DataFrame:
    """Violation counts of a model: ``model, column, check, violations``.

    All not-null and accepted-values checks share one scan; each unique or foreign-key check adds its own.
    """
    spark = df.sparkSession
    counted = [(c, "not_null", F.count_if(F.col(c).isNull())) for c in not_null]
    counted += [
        (c, "accepted_values", F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(values))))
        for c, values in (accepted or {}).items()
    ]
    results = []
    if counted:
        row = df.agg(*[count.alias(f"c{i}") for i, (_, _, count) in enumerate(counted)])
        entries = [
            F.struct(F.lit(c).alias("column"), F.lit(check).alias("check"), F.col(f"c{i}").alias("violations"))
            for i, (c, check, _) in enumerate(counted)
        ]
        results.append(row.select(F.inline(F.array(*entries))))
    for column in unique:
        keys = violations_unique(df, [column])
        results.append(_count(keys, column, "unique"))
    for column, parent, parent_column in foreign:
        results.append(_count(violations_fk(df, column, parent, parent_column), column, "relationships"))
    if not results:
        return spark.createDataFrame([], "model string, column string, check string, violations long")
    every = results[0]
    for more in results[1:]:
        every = every.unionByName(more)
    return every.select(F.lit(model).alias("model"), "column", "check", "violations")


def _count(rows: DataFrame, column: str, check: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(column).alias("column"), F.lit(check).alias("check"), "violations"
    )
