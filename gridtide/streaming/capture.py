"""The history of grid states as written runs: each run goes on from what the last finished one left.

Run n writes its carried state to a folder of its own and the changes it settles to a partition of the history; it
counts once it is in the list of runs, which is written last. A run that failed before that is written anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.grid_states import Carried, grid_state_run
from .ingest import stored_table


def last_run(spark: SparkSession, path: str) -> int:
    runs = stored_table(spark, f"{path}/runs")
    return 0 if runs is None else runs.agg(F.max("run")).first()[0]


def _folder(path: str, run: int) -> str:
    return f"{path}/carried/run={run}"


def carried_state(spark: SparkSession, path: str) -> Carried | None:
    """What the last finished run left, or None before the first."""
    run = last_run(spark, path)
    if not run:
        return None
    return Carried(*[spark.read.parquet(f"{_folder(path, run)}/{part}") for part in ("carry", "journal", "open")])


def capture_states(
    demand: DataFrame, path: str, weather: DataFrame, dates: DataFrame, bridge: DataFrame, days: int = 1
) -> None:
    """One more run over the demand that has arrived, added to the history at ``path``."""
    spark = demand.sparkSession
    run = last_run(spark, path) + 1
    step = grid_state_run(demand, weather, dates, bridge, carried_state(spark, path), days)
    parts = {
        f"{_folder(path, run)}/carry": step.carried.carry,
        f"{_folder(path, run)}/journal": step.carried.journal,
        f"{_folder(path, run)}/open": step.carried.open_changes,
        f"{path}/thresholds/run={run}": step.thresholds,
        f"{path}/settled/run={run}": step.settled,
    }
    for folder, df in parts.items():
        df.write.mode("overwrite").parquet(folder)
    spark.range(1).select(F.lit(run).alias("run")).write.mode("append").parquet(f"{path}/runs")


def captured_changes(spark: SparkSession, path: str) -> DataFrame:
    """All changes known after the last finished run: those settled in any run, and those still open."""
    run = last_run(spark, path)
    open_changes = spark.read.parquet(f"{_folder(path, run)}/open")
    settled = spark.read.parquet(f"{path}/settled").filter(F.col("run") <= run).select(*open_changes.columns)
    return settled.unionByName(open_changes)
