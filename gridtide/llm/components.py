"""Connected components of a link table by alternating large and small stars, each round written out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import forget, written

#: Edges, two numbers each, that one task takes whole, so that no round on them needs a shuffle.
FEW_EDGES = 50_000


def _large_star(edges: DataFrame, held) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = held(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, held) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = held(down.groupBy("u").agg(F.min("v").alias("m")))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written, in one partition if they are few, and a mark of what they are."""
    edges = written(edges, "edges")
    mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return (edges.coalesce(1) if mark[0] <= FEW_EDGES else edges), tuple(mark)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes with a link; the component is its least node. ``links`` has columns a, b.

    A link of a node to itself counts for nothing, as do links with a null end; no link gives no row.
    """
    edges, mark = _settled(links.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
    while mark[0]:
        last, before, tables = edges, mark, []

        def held(least: DataFrame, many: bool = mark[0] > FEW_EDGES) -> DataFrame:
            """Written where edges are many: a join with a written side can split a node that very many edges name."""
            if not many:
                return least
            tables.append(written(least, "least"))
            return tables[-1]

        edges, mark = _settled(_small_star(_large_star(last, held).where("u <> v").distinct(), held))
        forget(last, *tables)
        if mark == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v"), F.col("v")).distinct())
