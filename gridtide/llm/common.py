"""What several operators share: the shared folder, tables written once, labels and text patterns."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word is a longest run without ASCII white space.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as the session names it in ``spark.checkpoint.dir``.

    A session that runs in one process (a test) may leave the setting out; a folder in the warehouse then serves. On a
    cluster the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/steps"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


#: Parquet is read in batches of so many rows and in pieces of a few megabytes. Its vectored reader takes the texts of a
#: row group as one array, twice, on the heap and in a buffer outside it that the reading thread keeps.
IN_PIECES = {
    "spark.sql.parquet.columnarReaderBatchSize": "500",
    "parquet.hadoop.vectored.io.enabled": "false",
}
#: While a table is written, its shuffle files go as soon as nobody needs them, and Python workers get texts in batches of
#: so many rows: a batch of Spark's usual size can hold hundreds of megabytes of long texts. Parquet is read by as many.
WHILE_WRITING = IN_PIECES | {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}


def read_in_pieces(spark: SparkSession) -> None:
    """Sets for the session how Parquet is read, for a job whose tables of texts are written by its caller."""
    for key, value in IN_PIECES.items():
        spark.conf.set(key, value)


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """The settings above while a table is written; the session's own ones after it."""
    before = {key: spark.conf.get(key, None) for key in WHILE_WRITING}
    for key, value in WHILE_WRITING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    with writing(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame | None) -> None:
    """Removes written tables that nothing reads any more; other tables are left alone."""
    for df in tables:
        if df is None:
            continue
        spark = df.sparkSession
        own = f"/{spark.sparkContext.applicationId}/"
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles() if own in f}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Most ids that are sent to every executor to drop rows by; more are joined by shuffle.
BROADCAST_IDS = 1_000_000


def without(docs: DataFrame, ids: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``docs`` without the rows of these ids (the only column of ``ids``); rows without an id stay.

    The ids are written and counted first: while they are few, no text is moved to drop a row.
    """
    dropped = ids.toDF("dropped_id_").where("dropped_id_ IS NOT NULL").distinct()
    dropped = written(dropped, "dropped")
    if dropped.count() <= BROADCAST_IDS:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, F.col(doc) == F.col("dropped_id_"), "left_anti")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text as an array; none for a null or blank text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), 1)


def is_held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows whose crc32 of the id, written as text, is a multiple of ``folds``: never used for learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == 0


def held_out(doc_id: int, folds: int = 5) -> bool:
    """The same for one Python value."""
    return zlib.crc32(str(doc_id).encode()) % folds == 0
