"""The trie of all conversations' prefixes, built by halving depths as in a van Emde Boas layout.

A sequence of up to 2^k turns is cut at half depth. The upper halves form one trie, and below each distinct upper half
(a *cut*) hangs the trie of the lower halves that follow it; both are cut again, all of them at one level in the same
job, until parts are single turns. So there are about log2(longest) levels instead of one step a turn, and no task needs
a whole conversation. Four passes over the levels:

1. ``named_blocks``, upwards: aligned blocks of 2^k turns are named from the names of their halves.
2. ``halved``, downwards: parts (prefix before it, block) with their members. Equal parts are one row from the top on, so
   many equal conversations are as cheap as one. A part finds its halves by its least member and place, a unique key.
3. ``forest_totals``, upwards: sums over the forest that begins at a cut and is 2^k turns deep.
4. ``grafted``, downwards: what lies below a cut is its forest plus what lies below the cuts at that forest's lower edge.

Names are the first 128 bits of SHA-256; sums are partial before they are shuffled. The digest of the conversations that
end at a node is one sequence by definition: ids are sorted and packed in ranges first, then each node's packs stream
through one hash in constant memory.

Defined results: turns are ordered by turn (null first), then role, then text; a null role or text is empty; equal rows
are turns each. Rows without a conversation id belong to none. A conversation whose rebuilt form has no turn ends at
the root. An empty table has no nodes, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import forget, written

NAME = 16
ROOT = bytes(NAME)
#: Turns of one conversation that meet in one key of a join.
STRETCH = 4_096
#: Conversations whose number is c - c % GROUP lend their first turns; h = crc32(c) % LENT of them.
GROUP, LENT = 100, 6


def name_of(kind: bytes, *parts: Column) -> Column:
    """A 128-bit name; ``kind`` keeps names of turns, blocks and prefixes apart."""
    return F.unhex(F.substring(F.sha2(F.concat(F.lit(kind), *[p.cast("binary") for p in parts]), 256), 1, 2 * NAME))


def numbered(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns as (c, at, name, size) with ``at`` from 0 in each conversation, and conversations as (c, n_turns); both written.

    Rows are sorted in ranges, so a conversation may lie in several tasks. Each task counts from 0; a conversation that
    goes on in the next task gets an offset there. There are fewer of them than tasks, so the offsets are broadcast.
    """
    clean = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), clean(role).alias("role"), clean(text).alias("text")
    )
    order = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    # equal rows are told apart by their place, so that many of them need not meet in one task
    dealt = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*order, F.col("place")).sortWithinPartitions(*order)
    turn_name = name_of(b"t", F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, last, done = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            c = np.asarray(batch.column(0))
            begins = np.concatenate(([0], np.flatnonzero(np.diff(c)) + 1))
            sizes = np.diff(np.concatenate((begins, [len(c)])))
            at = np.arange(len(c)) - np.repeat(begins, sizes)
            if c[0] == last:
                at[: sizes[0]] += done
            last, done = c[-1], at[-1] + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at), pa.array(np.full(len(c), piece))], [*batch.schema.names, "at", "piece"])

    told = dealt.select("c", turn_name.alias("name"), F.length("text").cast("long").alias("size"))
    told = written(told.mapInArrow(number, "c long, name binary, size long, at long, piece long"), "turns")
    convs = written(told.groupBy("c").agg(F.count("*").alias("n_turns"), F.min("piece").alias("lo"), F.max("piece").alias("hi")), "convs")
    spread = convs.where("lo < hi").select("c")
    pieces = told.join(F.broadcast(spread), "c").groupBy("c", "piece").agg(F.count("*").alias("n"))
    before = Window.partitionBy("c").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(pieces.select("c", "piece", F.sum("n").over(before).alias("offset")).where("offset > 0"), "offsets")
    turns = told.join(F.broadcast(offsets), ["c", "piece"], "left")
    return turns.select("c", (F.col("at") + F.coalesce("offset", F.lit(0))).alias("at"), "name", "size"), convs.select("c", "n_turns")


def rebuilt(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one: (c, j, name, size, len) and (c, len).

    Conversation c takes the first h turns of c - c % GROUP, as many as there are, and then its own after the first h.
    """
    c = F.col("c")
    ids = convs.withColumns({"base": c - c % GROUP, "h": F.crc32(c.cast("string").cast("binary")) % LENT})
    lent = convs.where(c % GROUP == 0).select(c.alias("base"), F.least("n_turns", F.lit(LENT - 1)).alias("there"))
    lead = F.least("h", F.coalesce("there", F.lit(0)))
    plans = ids.join(lent, "base", "left").withColumn("lead", lead)
    plans = written(plans.withColumn("len", F.col("lead") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))), "plans")
    heads = turns.where((c % GROUP == 0) & (F.col("at") < LENT - 1)).withColumnRenamed("c", "base")
    taken = plans.select("c", "base", "h", "len").join(heads, "base").where("at < h").select("c", F.col("at").alias("j"), "name", "size", "len")
    # one key holds at most STRETCH turns of a conversation, however long it is
    stretch = lambda at: F.floor(at / STRETCH).cast("long")
    shifts = plans.where("n_turns > h").withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("long"), stretch(F.col("n_turns") - 1))))
    own = turns.withColumn("stretch", stretch(F.col("at"))).join(shifts, ["c", "stretch"]).where("at >= h")
    own = own.select("c", (F.col("at") - F.col("h") + F.col("lead")).alias("j"), "name", "size", "len")
    return taken.unionByName(own), plans.select("c", "len")


def named_blocks(turns: DataFrame) -> list[DataFrame]:
    """For each level k the written blocks (c, j, len, left, right, name) of up to 2^k turns; level 0 has ``size`` instead.

    A block without a right half has the name of its left half: a name says which turns, not at which level. Sequences
    that fit one block of the level below are not carried on.
    """
    levels = [written(turns, "blocks")]
    longest = levels[0].agg(F.max("len")).first()[0] or 0
    side = lambda odd: F.max(F.when(F.col("j") % 2 == odd, F.col("name")))
    while 1 << (len(levels) - 1) < longest:
        below = levels[-1].where(F.col("len") > 1 << (len(levels) - 1))
        pairs = below.groupBy("c", F.floor(F.col("j") / 2).cast("long").alias("j"), "len").agg(side(0).alias("left"), side(1).alias("right"))
        both = name_of(b"b", F.col("left"), F.col("right"))
        levels.append(written(pairs.withColumn("name", F.when(F.col("right").isNull(), F.col("left")).otherwise(both)), "blocks"))
    return levels


def whole_sequences(levels: list[DataFrame]) -> list[DataFrame]:
    """For each level the sequences that fit one of its blocks and none below: (c, whole)."""
    return [
        b.where((F.col("len") <= 1 << k) & (F.col("len") > (1 << k) // 2)).select("c", F.col("name").alias("whole")) for k, b in enumerate(levels)
    ]


@dataclass(frozen=True)
class Halved:
    """``nodes`` (j, prefix, n, m, cut, whole, size): depth less one, name of the prefix before, members, least member,
    the name under which longer prefixes know this node, the sequence that ends here, code points of the turn.
    ``cuts[k]`` (x, prefix, y): prefix x, cut at a level-k edge below ``prefix``; y is a cut at the forest's lower edge."""

    nodes: DataFrame
    cuts: list[DataFrame]


def halved(levels: list[DataFrame], wholes: list[DataFrame]) -> Halved:
    """From whole sequences down to single turns; equal parts are one row at every level."""

    def fresh(k: int) -> DataFrame:
        grouped = wholes[k].groupBy("whole").agg(F.count("*").alias("n"), F.min("c").alias("m"))
        zero, none = F.lit(0).cast("long"), F.lit(None).cast("binary")
        return grouped.select(zero.alias("j"), F.lit(ROOT).alias("prefix"), F.col("whole").alias("block"), "n", "m", none.alias("cut"), "whole")

    top = len(levels) - 1
    parts, cuts = fresh(top), []
    for k in range(top, 0, -1):
        # the block of the least member at this place is the part's block
        halves = parts.join(levels[k].select(F.col("c").alias("m"), "j", "left", "right"), ["m", "j"])
        x = F.when(F.col("right").isNotNull(), name_of(b"p", F.col("prefix"), F.col("left")))
        halves = written(halves.withColumn("x", x).drop("block"), "parts")
        upper = halves.select(
            (F.col("j") * 2).alias("j"), "prefix", F.col("left").alias("block"), "n", "m", F.col("x").alias("cut"), F.when(F.col("right").isNull(), F.col("whole")).alias("whole")
        )
        met = upper.union(fresh(k - 1)).groupBy("j", "prefix", "block")
        upper = met.agg(F.sum("n").alias("n"), F.min("m").alias("m"), F.max("cut").alias("cut"), F.max("whole").alias("whole"))
        lower = halves.where("right IS NOT NULL").select(
            (F.col("j") * 2 + 1).alias("j"), F.col("x").alias("prefix"), F.col("right").alias("block"), "n", "m", "cut", "whole"
        )
        parts = upper.union(lower)
        cuts.insert(0, halves.where("x IS NOT NULL").select("x", "prefix", F.col("cut").alias("y")))
    turns = levels[0].select(F.col("c").alias("m"), "j", "size")
    return Halved(written(parts.join(turns, ["m", "j"]).drop("block"), "nodes"), cuts)


def forest_totals(nodes: DataFrame, cuts: list[DataFrame]) -> list[DataFrame]:
    """For each level k (prefix, j, kids, leaves, saved): sums over the nodes up to 2^k turns below each prefix whose length j
    is a multiple of 2^k. ``kids`` is meant at level 0 only."""
    saved = (F.col("n") - 1) * F.col("size")
    sums = [F.count("*").alias("kids"), F.sum(F.col("cut").isNull().cast("long")).alias("leaves"), F.sum(saved).alias("saved")]
    totals = [written(nodes.groupBy("prefix", "j").agg(*sums), "totals")]
    for k, cut in enumerate(cuts):
        here, lower = totals[k].where(F.col("j") % (2 << k) == 0), totals[k].where(F.col("j") % (2 << k) != 0)
        hung = lower.withColumnRenamed("prefix", "x").join(cut.select("x", "prefix").distinct(), "x").withColumn("j", F.col("j") - (1 << k))
        both = here.unionByName(hung.drop("x")).groupBy("prefix", "j")
        totals.append(written(both.agg(*[F.sum(s).alias(s) for s in ("kids", "leaves", "saved")]), "totals"))
    return totals


def grafted(totals: list[DataFrame], cuts: list[DataFrame]) -> DataFrame:
    """(x, leaves, saved): all that lies below each prefix that has a child."""
    done = [totals[-1].select(F.col("prefix").alias("x"), "leaves", "saved")]
    for k in range(len(cuts) - 1, -1, -1):
        forest = totals[k].where(F.col("j") % (2 << k) != 0).select(F.col("prefix").alias("x"), "leaves", "saved")
        above = reduce(DataFrame.union, done).withColumnRenamed("x", "y")
        edge = cuts[k].where("y IS NOT NULL").select("x", "y").join(above, "y").drop("y")
        sums = forest.unionByName(edge).groupBy("x").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        done.append(written(sums, "below"))
    return reduce(DataFrame.union, done)


def end_digests(ends: DataFrame) -> DataFrame:
    """(whole, ends_sha256) of (c, whole): the hash of the ids in ascending order, joined by commas."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            packs = [(whole, [c for _, c in own]) for whole, own in groupby(rows, key=lambda r: r[0])]
            yield pa.RecordBatch.from_pylist(
                [{"whole": w, "first": ids[0], "ids": ",".join(map(str, ids))} for w, ids in packs],
                schema=pa.schema([("whole", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]),
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            out = []
            for whole, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if whole == last:
                    state.update(b",")
                else:
                    if state:
                        out.append((last, state.hexdigest()))
                    last, state = whole, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.binary()), pa.array([d for _, d in out], pa.string())], ["whole", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["whole", "ends_sha256"])

    ranges = ends.select("whole", "c").repartitionByRange("whole", "c").sortWithinPartitions("whole", "c")
    packs = ranges.mapInArrow(pack, "whole binary, first long, ids string").repartition("whole").sortWithinPartitions("whole", "first")
    return packs.select("whole", "ids").mapInArrow(digest, "whole binary, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """All nodes of the trie of ``turns`` (c, j, name, size, len) over the conversations ``convs`` (c, len)."""
    spark = turns.sparkSession
    total = convs.agg(F.count("*").alias("n"), F.min("c").alias("m")).first()
    levels = named_blocks(turns)
    wholes = whole_sequences(levels)
    found = halved(levels, wholes)
    totals = forest_totals(found.nodes, found.cuts)
    below = grafted(totals, found.cuts)
    turnless = convs.where("len = 0").select("c", F.lit(ROOT).alias("whole"))
    digests = written(end_digests(reduce(DataFrame.union, [turnless, *wholes])), "ends")
    forget(*levels[1:])
    # a sequence without turns ends at the root, whose name no sequence bears
    zero, name = F.lit(0).cast("long"), F.lit(ROOT)
    root = [zero, F.lit(None).cast("binary"), F.lit(total.n), F.lit(total.m).cast("long"), name, name, zero]
    nodes = found.nodes.select((F.col("j") + 1).alias("depth"), "prefix", "n", "m", "cut", "whole", "size")
    nodes = nodes.union(spark.range(min(total.n, 1)).select(*root))
    # most nodes have no cut or end no sequence: they get keys of their own that match nothing, not one NULL for all
    own = F.concat(F.lit(b"own"), F.coalesce("prefix", F.lit(b"")), F.col("m").cast("string").cast("binary"))
    keyed = nodes.withColumns({"below_key": F.coalesce("cut", own), "whole_key": F.coalesce("whole", own)})
    parents = nodes.where("cut IS NOT NULL").select(F.col("cut").alias("prefix"), F.col("m").alias("parent_conv_id"))
    kids = totals[0].select(F.col("prefix").alias("below_key"), "kids")
    rows = keyed.join(kids, "below_key", "left").join(below.withColumnRenamed("x", "below_key"), "below_key", "left")
    rows = rows.join(digests.withColumnRenamed("whole", "whole_key"), "whole_key", "left").join(parents, "prefix", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return rows.select(
        F.col("m").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.coalesce("kids", F.lit(0)).cast("long").alias("n_children"),
        F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
        (F.coalesce("saved", F.lit(0)) + (F.col("n") - 1) * F.col("size")).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of a table (conv_id, turn, role, text)."""
    return trie(*rebuilt(*numbered(conversations)))
