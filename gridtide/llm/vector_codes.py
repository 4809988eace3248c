"""Short codes of vectors: a codebook per part of the vector, learned by Lloyd rounds whose members stay where they are.

Components become integers (``floor(scale * x)``) and vectors are cut into equal parts. A part is a member of the
nearest entry of its position's codebook and lies with the owner of (position, entry, salt); owners have the same few
thousand members each, so an entry that holds a third of all parts has a third of all owners. In a round every owner
sums its resident members, the sums of owners make the new entries, and every owner puts its members to the new
codebook: those that keep their entry stay in the file they lie in, only those that change it go through the shuffle.
A codebook has ``parts * entries`` rows, a bound that does not grow with the table; so it is held by the driver and
sent to the tasks. At the end the vectors are read once more and coded with the last codebooks, without a shuffle.

Defined results: a vector that is null, empty, or holds a null or non-finite component is left out, and so is one whose
length differs from that of the kept vector with the least id or is no multiple of ``parts``. Rows without an id are
coded and belong to their entries, but give no first entry; a table in which no row has an id gives no rows. Repeated
rows are coded each on its own; of rows that share an id the least vector gives the first entry. Fewer ids than
``entries`` give smaller codebooks. Equal distances go to the lower index, an entry without members stays as it is.
Components are clamped where a squared distance of two vectors would not fit a long (for 64 components at 742,000).
Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .common import forget, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Members of an owner, about.
OWNER_ROWS = 4_096
#: Sums of so many labels at most are sent to all tasks; more are joined in a shuffle, spread by a salt.
BROADCAST_LABELS, LABEL_SALTS = 200_000, 64
#: Distances computed at a time.
BLOCK = 2_048

RESIDENT = "position int, entry int, salt int, part array<int>"


@dataclass(frozen=True)
class Layout:
    """How vectors become integers and are cut."""

    dims: int
    parts: int
    scale: float

    @property
    def width(self) -> int:
        return self.dims // self.parts

    @property
    def limit(self) -> int:
        return math.isqrt((2**63 - 1) // self.dims) // 2

    def integers(self, vectors: pa.Array) -> np.ndarray:
        """One row of integers a vector; all vectors have ``dims`` components."""
        x = np.floor(_flat(vectors).astype(np.float64) * self.scale)
        return np.clip(x, -self.limit, self.limit).astype(np.int64).reshape(-1, self.dims)


def _flat(lists: pa.Array) -> np.ndarray:
    return np.asarray(lists.flatten())


def nearest(members: np.ndarray, books: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of ``books[position]`` for each member; ties to the lower index."""
    entry, error = np.zeros(len(members), dtype=np.int32), np.zeros(len(members), dtype=np.int64)
    for at in range(0, len(members), BLOCK):
        block = slice(at, at + BLOCK)
        away = members[block, None, :] - books[position[block]]
        squares = np.einsum("nec,nec->ne", away, away)
        entry[block] = squares.argmin(axis=1)
        error[block] = squares.min(axis=1)
    return entry, error


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.astype(np.int32).ravel()))


def kept_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has components, all of them finite."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)


def first_books(kept: DataFrame, id: str, vector: str, layout: Layout, entries: int) -> np.ndarray:
    """The vectors of the least ids, cut into parts: (position, entry, component)."""
    ids = [r[0] for r in kept.where(F.col(id).isNotNull()).select(id).distinct().orderBy(id).limit(entries).collect()]
    # at most `entries` rows reach the driver, however often an id is repeated
    rows = kept.where(F.col(id).isin(ids)).groupBy(id).agg(F.min(vector).alias(vector)).orderBy(id).select(vector).collect()
    whole = layout.integers(pa.array([r[0] for r in rows], type=pa.list_(pa.float64())))
    return whole.reshape(len(rows), layout.parts, layout.width).transpose(1, 0, 2).copy()


def first_members(kept: DataFrame, vector: str, layout: Layout, books: np.ndarray, salts: int) -> DataFrame:
    """Every part of every vector with its entry and a salt, not yet at its owner."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() * 7919
        for batch in batches:
            whole = layout.integers(batch.column(0))
            members = whole.reshape(-1, layout.width)
            position = np.tile(np.arange(layout.parts, dtype=np.int32), len(whole))
            entry, _ = nearest(members, books, position)
            salt = np.repeat((at + np.arange(len(whole))) % salts, layout.parts).astype(np.int32)
            at += len(whole)
            yield pa.RecordBatch.from_arrays(
                [pa.array(position), pa.array(entry), pa.array(salt), _lists(members)], ["position", "entry", "salt", "part"]
            )

    return kept.select(vector).mapInArrow(cut, RESIDENT)


def updated(members: DataFrame, books: np.ndarray) -> np.ndarray:
    """New entries from the sums of resident members; a task sends at most one row an entry."""
    width = books.shape[2]
    sums = [F.sum(F.col("part")[i].cast("long")).alias(f"s{i}") for i in range(width)]
    new = books.copy()
    for r in members.groupBy("position", "entry").agg(F.count("*").alias("n"), *sums).collect():
        new[r.position, r.entry] = [r[f"s{i}"] // r.n for i in range(width)]
    return new


def reassigned(members: DataFrame, books: np.ndarray) -> DataFrame:
    """Members with the entry they now belong to (``target``); nothing moves yet."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _flat(batch.column("part")).astype(np.int64).reshape(-1, books.shape[2])
            target, _ = nearest(rows, books, np.asarray(batch.column("position")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(target)], [*batch.schema.names, "target"])

    return members.mapInArrow(put, f"{RESIDENT}, target int")


def at_owners(members: DataFrame) -> DataFrame:
    return members.repartition("position", "entry", "salt")


def learned(kept: DataFrame, vector: str, layout: Layout, books: np.ndarray, rows: int, rounds: int) -> np.ndarray:
    """The codebooks after ``rounds`` rounds of assignment and update."""
    if not rounds:
        return books
    salts = max(1, -(-rows // OWNER_ROWS))
    tables = [written(at_owners(first_members(kept, vector, layout, books, salts)), "members")]
    members = tables[0]
    for left in range(rounds, 0, -1):
        books = updated(members, books)
        if left == 1:
            break
        told = written(reassigned(members, books), "members")
        stay = told.where("target = entry").drop("target")
        move = told.where("target <> entry").select("position", F.col("target").alias("entry"), "salt", "part")
        came = written(at_owners(move), "moved")
        forget(*tables)
        tables, members = [told, came], stay.union(came)
    forget(*tables)
    return books


def encoded(kept: DataFrame, id: str, vector: str, label: str, layout: Layout, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every row."""
    ids, labels = kept.schema[id].dataType, kept.schema[label].dataType
    schema = T.StructType(
        [
            T.StructField("vec_id", ids),
            T.StructField("label", labels),
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
        ]
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = layout.integers(batch.column(2)).reshape(-1, layout.width)
            entry, error = nearest(members, books, np.tile(np.arange(layout.parts), batch.num_rows))
            codes = [row.tobytes().hex() for row in entry.astype(np.uint8).reshape(-1, layout.parts)]
            total = error.reshape(-1, layout.parts).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes), pa.array(total)], schema.names)

    return kept.select(id, label, vector).mapInArrow(code, schema)


def with_label_error(coded: DataFrame, broadcast_labels: int = BROADCAST_LABELS) -> DataFrame:
    """``coded`` with its errors summed over equal labels; rows without a label count as one label."""
    sums = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    if sums.count() <= broadcast_labels:
        small = F.broadcast(sums.withColumnRenamed("label", "of"))
        return coded.join(small, F.col("label").eqNullSafe(F.col("of"))).drop("of")
    many = sums.select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))).alias("of_salt"))
    dealt = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(LABEL_SALTS)).cast("int"))
    return dealt.join(many, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("of_salt"))).drop("of", "salt", "of_salt")


def books_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.ravel().tolist()))


def coded(
    df: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: float = SCALE,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept row."""
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits: 1 to 256 entries")
    # its own names, so that no other column clashes
    df = df.select(F.col(id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).alias("label"))
    kept = kept_vectors(df, "vector").where(F.size("vector") % parts == 0)
    dims = kept.where("vec_id IS NOT NULL").agg(F.min(F.struct("vec_id", F.size("vector").alias("size")))).first()[0]
    if dims is None:
        empty = kept.limit(0)
        return empty.select(
            "vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256")
        )
    layout = Layout(dims["size"], parts, scale)
    kept = kept.where(F.size("vector") == layout.dims)
    books = first_books(kept, "vec_id", "vector", layout, entries)
    books = learned(kept, "vector", layout, books, kept.count(), rounds)
    rows = written(encoded(kept, "vec_id", "vector", "label", layout, books), "codes")
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    out = with_label_error(rows)
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
