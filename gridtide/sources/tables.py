"""Table writers: append, refresh, view, partitioned refresh, and tables that hold an intermediate result."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def stamped(df: DataFrame, column: str = "loaded_at") -> DataFrame:
    """Adds the load time. Only writers call this, so results themselves do not depend on the clock."""
    return df.withColumn(column, F.current_timestamp())


def append_raw(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def refresh_table(df: DataFrame, path: str, audit: bool = True) -> None:
    (stamped(df) if audit else df).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def refresh_partitions(df: DataFrame, path: str, partition: Sequence[str], audit: bool = True) -> None:
    """Replaces only the partitions ``df`` holds rows for.

    Rows are first gathered by partition value so that a partition is not split into one file per task; the
    rebalance splits a partition that is too large for one file and survives a hot value.
    """
    out = stamped(df) if audit else df
    (
        out.hint("rebalance", *partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .parquet(path)
    )


def merge_partitions(updates: DataFrame, path: str, keys: Sequence[str], partition: str) -> None:
    """Updates and inserts rows in a table partitioned by one column; only partitions with updates are read and written.

    ``updates`` has all columns of the table and is settled, since it is read three times. The writer stages its files
    and replaces partitions when it commits, so it may read the ones it replaces, and a failed merge can be repeated.
    """
    spark = updates.sparkSession
    values = [r[0] for r in updates.select(partition).distinct().collect()]
    target = spark.read.parquet(path)
    held = target.filter(F.col(partition).isin(values))
    renamed = updates.select(*[F.col(c).alias(f"_{c}") for c in keys])
    kept = held.join(renamed, [held[c].eqNullSafe(renamed[f"_{c}"]) for c in keys], "left_anti")
    refresh_partitions(kept.unionByName(updates.select(*kept.columns)), path, [partition], audit=False)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A session in one process (``local[...]``) may leave it out; a folder in the warehouse serves then.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/steps"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, name: str = "step") -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back.

    For a result that several later steps read. The written files survive lost executors, and their size is
    known to the planner, so the joins that follow choose broadcast or shuffle by the true size.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
