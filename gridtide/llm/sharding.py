"""Shards of bounded size by extendible hashing, in DataFrame functions only.

A document belongs to the bucket named by the first bits of its hash. All buckets start at the same depth; one that
exceeds the byte limit is split on its next bit, others stay, so the directory is uneven where the data are. Every
round sums bytes and rows of the split buckets only, grouped by prefix, and moves the sums, never the texts.

The directory lists each final bucket (``depth``, ``prefix``) with its shard number in hash order. A document finds
its bucket by looking its hash prefix up at each depth in use: one equi join.

A bucket whose hash bits are used up (rows with the same key, or one document above the limit) cannot be split by
hashing. Its rows are laid on overflow pages by their running bytes. A single document above the limit has a page, and
so a shard, of its own.

Defined results: a null text has no bytes; null keys hash alike and are kept; repeated rows are placed one by one; an
empty table gives an empty result; columns named like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

LIMIT_BYTES = 4_000_000
HASH_BITS = 60
STEP_BITS = 4


def hash_key(*keys: Column) -> Column:
    """The first 60 bits of the md5 of the keys as text, which other engines compute alike."""
    text = F.concat_ws("\x1f", *[F.coalesce(k.cast("string"), F.lit("\x00")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def prefix(hashed: Column, depth: int) -> Column:
    return F.shiftright(hashed, HASH_BITS - depth)


def directory(sized: DataFrame, limit: int, step: int = STEP_BITS) -> DataFrame:
    """Final buckets: (depth, prefix, bytes, n_rows, full), from rows of (hashed, bytes).

    Each round takes ``step`` more bits of the oversized buckets at once. A bucket that fits is final at the shortest
    prefix at which it fits while its parent does not, which is where splitting bit by bit would have left it.
    """
    spark = sized.sparkSession
    depth, final = 0, []
    open_rows = sized
    while True:
        low, depth = depth, min(depth + step, HASH_BITS)
        cells = written(
            open_rows.groupBy(prefix(F.col("hashed"), depth).alias("prefix"))
            .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n_rows")),
            "cells",
        )
        # sums of the inner levels come from the cells, not from the documents again
        parent_full = None
        for d in range(low if low == 0 else low + 1, depth + 1):
            level = cells.groupBy(F.shiftright("prefix", depth - d).alias("prefix")).agg(
                F.sum("bytes").alias("bytes"), F.sum("n_rows").alias("n_rows")
            )
            if parent_full is not None:
                up = parent_full.select(F.col("prefix").alias("up_"))
                level = level.join(up, F.shiftright("prefix", 1) == F.col("up_"), "left_semi")
            level = level.withColumn("depth", F.lit(d))
            fits = level.where((F.col("bytes") <= limit) | (F.lit(d) == HASH_BITS))
            final.append(fits)
            parent_full = level.where(F.col("bytes") > limit)
        full = written(parent_full.select("prefix"), "full")
        if depth == HASH_BITS or full.isEmpty():
            break
        here = prefix(F.col("hashed"), depth)
        open_rows = open_rows.join(full.withColumnRenamed("prefix", "full_"), here == F.col("full_"), "left_semi")
    out = final[0]
    for more in final[1:]:
        out = out.unionByName(more)
    return out.select("depth", "prefix", "bytes", "n_rows", (F.col("bytes") > limit).alias("full"))


def numbered(buckets: DataFrame) -> DataFrame:
    """Buckets with ``shard_id``: their rank in hash order. The directory has a row per shard, not per document."""
    first = F.call_function("shiftleft", F.col("prefix"), (F.lit(HASH_BITS) - F.col("depth")).cast("int"))
    return buckets.withColumn("shard_id", F.row_number().over(Window.orderBy(first)).cast("long") - 1)


def assign(
    docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT_BYTES, step: int = STEP_BITS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: the key, the columns to ``carry``, ``n_bytes``, ``depth``, ``prefix``, ``shard_id`` and ``page``.

    ``page`` is 0 unless the bucket overflows. Overflowing rows above half the limit have a page each; the others are
    dealt by their running bytes, half a limit to a page, so that a page with its last row still fits.
    """
    rows = docs.select(
        F.col(key),
        *[F.col(c) for c in carry],
        hash_key(F.col(key)).alias("hashed"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    sized = written(rows.select("hashed", F.col("n_bytes").alias("bytes")), "sized")
    buckets = written(numbered(directory(sized, limit, step)), "directory")
    depths = sorted(r[0] for r in buckets.select("depth").distinct().collect())  # at most 61 values
    places = [F.struct(F.lit(d).alias("depth"), prefix(F.col("hashed"), d).alias("prefix")) for d in depths or [0]]
    lookup = (
        sized.select("hashed").distinct().select("hashed", F.explode(F.array(*places)).alias("at"))
        .select("hashed", "at.depth", "at.prefix")
        .join(buckets.select("depth", "prefix", "shard_id", "full"), ["depth", "prefix"])
    )
    placed = rows.join(lookup, "hashed")
    columns = [key, *carry, "n_bytes", "depth", "prefix", "shard_id"]
    fits = placed.where(~F.col("full")).select(*columns, F.lit(0).cast("long").alias("page"))
    if not buckets.where("full").limit(1).count():
        return fits
    return fits.unionByName(_pages(placed.where("full").select(*columns), limit).select(*columns, "page"))


def _pages(over: DataFrame, limit: int) -> DataFrame:
    """Running bytes over rows that are alike: within each written part, after the sums of the parts before it."""
    held = written(over, "overflow").withColumns(
        {
            "part_": F.spark_partition_id(),
            "at_": F.monotonically_increasing_id(),
            "alone_": F.col("n_bytes") * 2 > limit,
        }
    )
    held = held.withColumn("unit_", F.when(F.col("alone_"), F.lit(1)).otherwise(F.col("n_bytes")))
    of_part = Window.partitionBy("shard_id", "alone_", "part_").orderBy("at_")
    sums = held.groupBy("shard_id", "alone_", "part_").agg(F.sum("unit_").alias("sum_"))
    before = Window.partitionBy("shard_id", "alone_").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start_", F.coalesce(F.sum("sum_").over(before), F.lit(0))).drop("sum_")
    run = F.col("start_") + F.sum("unit_").over(of_part.rowsBetween(Window.unboundedPreceding, 0)) - F.col("unit_")
    page = F.when(F.col("alone_"), -1 - run).otherwise(F.floor(run / F.lit(max(1, limit // 2))))
    return held.join(starts, ["shard_id", "alone_", "part_"]).withColumn("page", page.cast("long"))


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT_BYTES) -> None:
    """Writes one folder per shard and page; the rebalance splits none of them and gathers small ones."""
    extra = tuple(c for c in docs.columns if c != key)
    placed = assign(docs, key, text, limit, carry=extra)
    placed.repartition("shard_id", "page").write.partitionBy("shard_id", "page").parquet(path)
