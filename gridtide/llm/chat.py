"""Preference formatting: chosen and rejected conversations as one prompt with two masked completions.

For a pair, the longest common prefix of turns (equal role and text) is the prompt, rendered once. Each side's other
turns are its completion. If one conversation is a prefix of the other, or both are the same, its completion is empty.
A completion trains on assistant turns only: ``spans`` lists the character ranges, within the completion, that count
for the loss; everything else is masked.

Defined results: a null role or text equals a null one and renders as empty; turns with the same number are ordered by
role, then text; a conversation that is absent has no turns; repeated pairs are formatted once each; empty tables give
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

OPEN, MIDDLE, CLOSE = "<|", "|>\n", "\n"


def rendered(turn: Column) -> Column:
    """One turn as text: its role in marks, its text, a line end."""
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit(MIDDLE), F.coalesce(turn["text"], F.lit("")), F.lit(CLOSE))


def gathered(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation with its turns in order."""
    turn = F.struct(F.col("turn"), F.col("role"), F.col("text"))
    return turns.groupBy(F.col(conv).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def opening_pairs(turns: DataFrame) -> DataFrame:
    """Pairs by shared opening: of conversations that open with the same role and text, the one with most turns (ties:
    smallest id) is chosen over each of the others. A conversation whose opening nobody shares pairs with nothing.

    Groups are found by key and met again by join, so a very common opening is not gathered anywhere.
    """
    first = turns.groupBy("conv_id").agg(
        F.min(F.struct("turn", "role", "text")).alias("open"), F.count("*").alias("n_turns")
    )
    keyed = first.select(
        "conv_id", "n_turns", F.sha2(F.to_json(F.struct("open.role", "open.text")), 256).alias("opening")
    )
    best = keyed.groupBy("opening").agg(
        F.min(F.struct((-F.col("n_turns")).alias("fewest"), F.col("conv_id"))).alias("best"), F.count("*").alias("n")
    )
    # written first, so that the join can split an opening that very many share
    best = written(best.where("n > 1").drop("n"), "openings")
    met = keyed.join(best, "opening").where(~F.col("conv_id").eqNullSafe(F.col("best.conv_id")))
    return met.select(F.col("best.conv_id").alias("chosen_id"), F.col("conv_id").alias("rejected_id"))


def common_prefix(a: Column, b: Column) -> Column:
    """How many leading turns are equal in role and text."""
    equal = F.zip_with(a, b, lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"])
                       & x.isNotNull() & y.isNotNull())
    differs = F.array_position(equal, False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(equal).cast("long")).cast("int")


def loss_spans(turns: Column) -> Column:
    """Character ranges [begin, end) of the assistant texts in the rendered turns, with the closing line end."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))

    def step(held: Column, turn: Column) -> Column:
        begin = held["at"] + F.length(F.concat(F.lit(OPEN + MIDDLE), F.coalesce(turn["role"], F.lit(""))))
        end = held["at"] + F.length(rendered(turn))
        span = F.array(F.struct(begin.alias("begin"), end.alias("end")))
        spans = F.when(turn["role"] == "assistant", F.concat(held["spans"], span)).otherwise(held["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step)["spans"]


def with_turns(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs of ids with the turns of both conversations."""
    convs = gathered(turns)
    none = F.array().cast(convs.schema["turns"].dataType)
    side = lambda name: convs.select(F.col("conv_id").alias(f"{name}_id"), F.col("turns").alias(f"{name}_turns"))
    both = pairs.join(side("chosen"), "chosen_id", "left").join(side("rejected"), "rejected_id", "left")
    return both.withColumns({f"{s}_turns": F.coalesce(f"{s}_turns", none) for s in ("chosen", "rejected")})


def next_ids(ids: DataFrame) -> DataFrame:
    """(conv_id, donor_id): to each of the distinct ids the next one in order, to the last the first.

    Ids are sorted in ranges, and a range's last id takes the first one of the next range that has any; only the first
    ids of the ranges, as many as there are tasks, are looked at together.
    """
    ranged = ids.repartitionByRange("conv_id").sortWithinPartitions("conv_id").withColumn("range", F.spark_partition_id())
    ranged = written(ranged, "ranges")
    firsts = ranged.groupBy("range").agg(F.min("conv_id").alias("first"))
    after = F.lead("first").over(Window.orderBy("range"))
    firsts = firsts.select("range", F.coalesce(after, F.min("first").over(Window.partitionBy())).alias("beyond"))
    inside = F.lead("conv_id").over(Window.partitionBy("range").orderBy("conv_id"))
    return ranged.withColumn("inside", inside).join(F.broadcast(firsts), "range").select(
        "conv_id", F.coalesce("inside", "beyond").alias("donor_id")
    )


def swapped_endings(turns: DataFrame) -> DataFrame:
    """Pairs for conversations without a rejected partner: each conversation up to its last assistant turn, which is
    exchanged for the last assistant turn of the next conversation that has one; the last takes that of the first.
    A conversation without an assistant turn, or without an id, gives no pair, and neither does a single one.
    """
    convs = gathered(turns.where("conv_id IS NOT NULL"))
    answers = F.filter(F.col("turns"), lambda t: t["role"] == "assistant")
    convs = written(convs.where(F.size(answers) > 0).withColumn("ending", F.element_at(answers, -1)), "answered")
    donors = next_ids(convs.select("conv_id")).where("conv_id <> donor_id")
    last = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i)))
    own = convs.select("conv_id", "turns", last.alias("last_")).join(donors, "conv_id")
    met = own.join(convs.select(F.col("conv_id").alias("donor_id"), "ending"), "donor_id")
    return met.select(
        F.col("conv_id").alias("chosen_id"),
        F.col("turns").alias("chosen_turns"),
        F.col("donor_id").alias("rejected_id"),
        F.concat(F.slice("turns", F.lit(1), F.col("last_")), F.array("ending")).alias("rejected_turns"),
    )


def format_pairs(both: DataFrame) -> DataFrame:
    """One row per pair: prompt, and text and loss spans of both completions."""
    both = both.withColumn("n_shared", common_prefix(F.col("chosen_turns"), F.col("rejected_turns")))
    text = lambda part: F.array_join(F.transform(part, rendered), "")
    rest = lambda s: F.slice(f"{s}_turns", F.col("n_shared") + 1, F.greatest(F.size(f"{s}_turns"), F.lit(1)))
    both = both.withColumns({"chosen_rest": rest("chosen"), "rejected_rest": rest("rejected")})
    return both.select(
        "chosen_id",
        "rejected_id",
        "n_shared",
        text(F.slice("chosen_turns", F.lit(1), F.col("n_shared"))).alias("prompt"),
        text(F.col("chosen_rest")).alias("chosen"),
        text(F.col("rejected_rest")).alias("rejected"),
        loss_spans(F.col("chosen_rest")).alias("chosen_spans"),
        loss_spans(F.col("rejected_rest")).alias("rejected_spans"),
    )
