"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions only.

Documents hang on a tree: domain, language, source. A token budget at the root goes down by weight: each node gets its
share of its parent's budget. A leaf can give its tokens times ``max_epochs`` at most. What a node cannot take goes to
its siblings first, by their weights, and only what all siblings together cannot take reaches the ancestors' siblings.
That is the same as settling each level from the root down with the capacity of whole subtrees: among the children of
a node the budget is dealt by weight, children that are full keep their capacity, and the rest is dealt again among
the others until none overflows.

A leaf takes its budget from seeded epochs: whole epochs as long as they fit, then a prefix of one more, in which the
documents stand in the order of a hash of seed, epoch and id. A document is taken if the tokens before it stay below
what the budget leaves. The end of the prefix is found without gathering a leaf: tokens are summed by the first bits
of the hash, the cell where the budget ends is refined by further bits, and only when it is small are its rows ordered.
The plan has one row per leaf; documents meet it by one join and no text is shuffled for it.

Defined results: a null level is a node of its own ("\\u2400"); null and blank texts have no tokens and stand where
their hash puts them; a leaf without any token costs nothing and is taken once; rows with one id stand at one place and are taken together; equal weights are the default; a weight
of 0 or a missing one in a given table takes only what nobody else can; an empty table gives an empty result; columns
named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, forget, written

LEVELS = ("domain", "lang", "source")
NULL_NODE = "␀"
HASH_BITS = 60
SMALL_CELL = 50_000


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(children: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Adds ``budget`` to rows of (parent columns, parent_budget, weight, capacity).

    The level at which siblings fill up: with ratio capacity / weight, those below the common ratio are full and the
    others share the rest by weight. Sorted by ratio, the full ones are a prefix, found by running sums; the nodes of
    a level number as many as there are sources, not documents. Siblings of weight 0 share by capacity what is left.
    """
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight"))
    order = Window.partitionBy(*parent).orderBy(F.col("ratio_").asc_nulls_last(), *[F.col(c) for c in children.columns if c.startswith("n_")])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy(*parent)
    rows = children.withColumn("ratio_", ratio)
    rows = rows.withColumns(
        {
            "cap_before_": F.coalesce(F.sum("capacity").over(before), F.lit(0.0)),
            "weight_left_": F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    # a child is full if dealing what is left at its place in the order would give it its capacity or more
    left = F.col("parent_budget") - F.col("cap_before_")
    rows = rows.withColumn(
        "full_", (F.col("weight") > 0) & (left * F.col("weight") >= F.col("capacity") * F.col("weight_left_"))
    )
    sums = {
        "full_cap_": F.coalesce(F.sum(F.when(F.col("full_"), F.col("capacity"))).over(everyone), F.lit(0.0)),
        "open_weight_": F.coalesce(F.sum(F.when(~F.col("full_"), F.col("weight"))).over(everyone), F.lit(0.0)),
        "zero_cap_": F.coalesce(F.sum(F.when(F.col("weight") <= 0, F.col("capacity"))).over(everyone), F.lit(0.0)),
    }
    rest = F.greatest(F.col("parent_budget") - F.col("full_cap_"), F.lit(0.0))
    budget = (
        F.when(F.col("full_"), F.col("capacity"))
        .when(F.col("weight") > 0, rest * F.col("weight") / F.col("open_weight_"))
        .when(F.col("open_weight_") > 0, F.lit(0.0))
        .when(F.col("zero_cap_") > 0, F.least(F.col("capacity"), rest * F.col("capacity") / F.col("zero_cap_")))
        .otherwise(F.lit(0.0))
    )
    out = rows.withColumns(sums).withColumn("budget", budget)
    return out.select(*children.columns, "budget")


def budgets(leaves: DataFrame, total: float, levels: Sequence[str], max_epochs: int, weights: DataFrame | None) -> DataFrame:
    """Leaf budgets, from leaves of (levels, tokens): propagated from the root level by level."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * F.lit(float(max_epochs)))
    held = None
    for depth in range(1, len(levels) + 1):
        path, parent = list(levels[:depth]), list(levels[: depth - 1])
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        if weights is None:
            nodes = nodes.withColumn("weight", F.lit(1.0))
        else:
            of_level = weights.where(F.size("path") == depth).select(
                *[F.col("path")[i].alias(c) for i, c in enumerate(path)], F.col("weight").cast("double")
            )
            nodes = nodes.join(of_level, path, "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
        nodes = nodes.withColumn("n_node", F.concat_ws("/", *path))  # a stated order among equal ratios
        if parent:
            nodes = nodes.join(held.select(*parent, F.col("budget").alias("parent_budget")), parent)
        else:
            nodes = nodes.withColumn("parent_budget", F.least(F.lit(float(total)), F.sum("capacity").over(Window.partitionBy(F.lit(0)))))
        held = water_fill(nodes, parent or [F.lit(0)]).select(*path, "budget")
    return held


def rank_hash(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Place of a document within an epoch: 60 bits of the md5 of seed, epoch and id."""
    key = F.concat_ws("-", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def domain_of(source: Column) -> Column:
    """The domain of a source that states none: its name without the last digit."""
    return F.regexp_replace(source.cast("string"), r"\d$", "")


def leaf_columns(domain: Column | None = None) -> dict[str, Column]:
    domain = domain_of(F.col("source")) if domain is None else domain
    levels = {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}
    return {f"leaf_{c}": F.coalesce(v.cast("string"), F.lit(NULL_NODE)) for c, v in levels.items()}


def measured(docs: DataFrame, domain: Column | None = None, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Narrow rows: id, leaf and tokens of every document, written once."""
    return written(
        docs.select(
            F.col(doc).alias("id_"),
            *[v.alias(c) for c, v in leaf_columns(domain).items()],
            n_tokens(F.col(text)).alias("n_tokens"),
        ),
        "measured",
    )


def weight_table(rows: DataFrame, domains: dict[str, float], langs: dict[str, float], other: float = 1.0) -> DataFrame:
    """(path, weight) for every node of the measured rows: stated weights by domain and by language, ``other`` for names
    that are not stated; sources of one domain and language weigh the same."""
    levels = [f"leaf_{c}" for c in LEVELS]
    nodes = rows.select(*levels).distinct()

    def stated(column: str, weights: dict[str, float]) -> Column:
        found = F.lit(float(other))
        for name, weight in weights.items():
            found = F.when(F.col(column) == name, F.lit(float(weight))).otherwise(found)
        return found

    of_level = [stated(levels[0], domains), stated(levels[1], langs), F.lit(1.0)]
    tables = [
        nodes.select(F.array(*levels[: depth + 1]).alias("path"), weight.alias("weight")).distinct()
        for depth, weight in enumerate(of_level)
    ]
    return written(tables[0].union(tables[1]).union(tables[2]), "weights")


def filled(rows: DataFrame, plan: DataFrame, seed: int, doc: str = "id_") -> DataFrame:
    """Per leaf: its tokens, its budget, and the tokens that all epochs take of it."""
    levels = [f"leaf_{c}" for c in LEVELS]
    taken = chosen(rows, plan, seed, doc).groupBy(*levels).agg(F.sum("n_tokens").alias("taken"))
    return plan.join(taken, levels, "left").select(*levels, "tokens", "budget", F.coalesce("taken", F.lit(0)).alias("taken"))


def leaf_plan(
    rows: DataFrame, fraction: float, weights: DataFrame | None = None, max_epochs: int = 1, seed: int = 7
) -> DataFrame:
    """Per leaf: ``budget``, ``n_full`` whole epochs, and ``until``, the first place beyond the next epoch's prefix."""
    levels = [f"leaf_{c}" for c in LEVELS]
    leaves = written(rows.groupBy(*levels).agg(F.sum("n_tokens").cast("double").alias("tokens")), "leaves")
    total = (leaves.agg(F.sum("tokens")).first()[0] or 0.0) * fraction
    dealt = budgets(leaves, total, levels, max_epochs, weights).join(leaves, levels)
    full = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(1)).cast("int")
    dealt = written(
        dealt.withColumn("n_full", F.least(full, F.lit(max_epochs))).withColumn(
            "rest", F.col("budget") - F.col("n_full") * F.col("tokens")
        ),
        "budgets",
    )
    return written(_prefix_ends(rows, dealt, levels, seed), "plan")


def _prefix_ends(rows: DataFrame, dealt: DataFrame, levels: list[str], seed: int, step: int = 10) -> DataFrame:
    """Adds ``until``: rows of the partial epoch at smaller places are taken. Each round looks at one cell per leaf."""
    ends = dealt.where("rest > 0").select(*levels, "n_full", "rest")
    placed = rows.join(ends, levels).withColumn("place", rank_hash(seed, F.col("n_full") + 1, F.col("id_")))
    placed = placed.select(*levels, "rest", "place", "n_tokens")
    known, bits = None, 0
    while True:
        bits += step
        cell = F.shiftright("place", HASH_BITS - bits)
        sums = placed.groupBy(*levels, "rest", cell.alias("cell")).agg(
            F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")
        )
        before = Window.partitionBy(*levels).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
        # the last cell that still starts below the budget holds the end
        last = Window.partitionBy(*levels).orderBy(F.col("cell").desc())
        edge = sums.where("before < rest").withColumn("k_", F.row_number().over(last)).where("k_ = 1")
        edge = written(
            edge.select(*levels, F.col("cell").alias("edge_"), (F.col("rest") - F.col("before")).alias("left_"), "n"), "edge"
        )
        placed = (
            placed.join(edge.drop("n"), levels).where(cell == F.col("edge_"))
            .select(*levels, F.col("left_").alias("rest"), "place", "n_tokens")
        )
        placed = written(placed, "cell")
        if bits >= HASH_BITS or not edge.where(F.col("n") > SMALL_CELL).limit(1).count():
            break
    # rows at one place stand together, so their tokens are summed before they are ordered
    spots = placed.groupBy(*levels, "rest", "place").agg(F.sum("n_tokens").alias("tokens"))
    order = Window.partitionBy(*levels).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    taken = spots.withColumn("before", F.coalesce(F.sum("tokens").over(order), F.lit(0))).where("before < rest")
    until = taken.groupBy(*levels).agg((F.max("place") + 1).alias("until"))
    return dealt.join(until, levels, "left").select(*levels, "tokens", "budget", "n_full", F.coalesce("until", F.lit(0)).alias("until"))


def chosen(rows: DataFrame, plan: DataFrame, seed: int, doc: str, leaf: dict[str, Column] | None = None) -> DataFrame:
    """``rows`` once per epoch that takes them, with ``epoch``. ``leaf`` adds the leaf columns where they lack."""
    columns = rows.columns
    held = rows.withColumns(leaf) if leaf else rows
    levels = [f"leaf_{c}" for c in LEVELS]
    met = held.join(plan.select(*levels, "n_full", "until"), levels)
    more = rank_hash(seed, F.col("n_full") + 1, F.col(doc)) < F.col("until")
    epochs = F.col("n_full") + more.cast("int")
    return met.where(epochs > 0).select(*columns, F.explode(F.sequence(F.lit(1), epochs)).alias("epoch"))


def mix(
    docs: DataFrame,
    fraction: float = 0.9,
    weights: DataFrame | None = None,
    domain: Column | None = None,
    max_epochs: int = 1,
    seed: int = 7,
    doc: str = "doc_id",
    text: str = "text",
    stated: tuple[dict[str, float], dict[str, float]] | None = None,
) -> DataFrame:
    """``docs`` chosen to fill ``fraction`` of all tokens by weight, with ``epoch``.

    ``weights`` has rows of (path: array of node names from the root, weight); without it siblings weigh the same, or
    by the ``stated`` weights of domains and languages (see :func:`weight_table`).
    """
    columns = [c for c in docs.columns if c != "epoch"]
    rows = measured(docs, domain, doc, text)
    if weights is None and stated is not None:
        weights = weight_table(rows, *stated)
    plan = leaf_plan(rows, fraction, weights, max_epochs, seed)
    forget(rows)
    return chosen(docs.select(*columns), plan, seed, doc, leaf_columns(domain)).select(*columns, "epoch")
