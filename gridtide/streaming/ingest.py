"""Landed files to tables with a file stream: each file is processed once, revisions win by upload time.

Every micro-batch is merged by ``foreachBatch``. A batch that is delivered again after a failure gives the same
table, because the merge keeps the newest upload per key and replaces whole partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.dedup import latest_by
from ..operators.upsert import fit_schema
from ..sources.landed import stamp_landed
from ..sources.tables import refresh_partitions, settle


def stream_landed_json(
    spark: SparkSession,
    path: str,
    name_pattern: str | None = None,
    tags: tuple[str, ...] = (),
    whole_file: bool = True,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The streaming form of ``read_landed_json``: only files that were not seen before."""
    reader = spark.readStream.format("text").option("wholetext", str(whole_file).lower())
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return stamp_landed(reader.load(path), name_pattern, tags)


def stored_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The parquet table at a path, or None before the first write."""
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def merge_into(
    updates: DataFrame, path: str, keys: Sequence[str], newest_first: Sequence[str], partition: Sequence[str]
) -> None:
    """Merges rows into a partitioned table; per key the newest row stays. Only partitions with updates are read
    and rewritten. The merged rows are first settled, so that a failed write never leaves a half-read table."""
    spark = updates.sparkSession
    updates = settle(updates, "batch")  # staged once, though it is read twice below
    target = stored_table(spark, path)
    if target is not None:
        touched = target.join(updates.select(*partition).distinct(), list(partition), "left_semi")
        touched, updates = fit_schema(touched, updates)
        updates = latest_by(touched.unionByName(updates), keys, newest_first)
    refresh_partitions(settle(updates, "merge"), path, partition, audit=False)


def ingest(
    stream: DataFrame,
    stage: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    newest_first: Sequence[str],
    partition: Sequence[str],
    after: Callable[[], None] | None = None,
) -> StreamingQuery:
    """Processes everything that has arrived and stops; start it again for the next batch of files.

    ``after`` runs once each batch is merged, for tables that follow this one (such as the captured states).
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        merge_into(stage(batch), path, keys, newest_first, partition)
        if after:
            after()

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
