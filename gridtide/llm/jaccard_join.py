"""Exact Jaccard join of word shingles as a metric-space join, and the components of its links.

Documents are sets of hashed 4-word shingles in the metric space of the Jaccard distance; documents with equal sets are
one point. Two points link at distance ``EPS`` or less.

**First regions.** Texts that have nothing in common lie at distance 1 from each other and from nearly every possible
document pivot, so Voronoi regions of sampled documents would have to hold copies of all documents. The first pivots are
therefore single shingles: under any order of the shingles a point within EPS of another shares one of its
``n - ceil(0.85 n) + 1`` first shingles (its *anchors*) with it, so a point is copied to the regions of its anchors, and
every link meets in at least one region. Regions with one point are dropped before anything is shuffled.

**Small regions.** Pairs of points that meet in regions of up to ``REGION`` points are counted over all such regions. An
anchor that the other side lacks is a difference for certain, so a pair that meets too seldom is out without a look at
its texts; points of crowded regions get as many meetings as they have such regions on top.

**Crowded regions** hold a shingle that many texts share. Their points are joined anew among themselves, in another
order of the shingles: those that occur repeatedly among a few members of each crowded region come last, the more
frequent the later. Texts that share a passage only then have other anchors. What still crowds are regions of points
made of common shingles nearly throughout: true families of near copies.

**Families** are joined by Voronoi regions. A few central members become pivots, every member is compared with them and linked
to those within EPS, and belongs to the nearest one. It is copied to another pivot's region only where the triangle
inequality lets a member of that region be within EPS of it: at most 2 EPS further away than its nearest pivot. In a
region members of the pivot's component that are too near the pivot to reach a member of another component are dropped,
and regions of one component are done. A region that is still large is joined by pivots of its own, unless it holds most of
what it was cut from: such a family lies within reach of all its pivots, and further ones would only copy it. In the others,
members outside the largest component meet the others, where distances to the pivot and certain differences allow a link
and one of the two is in the region of its nearest pivot.

Every pair that passes is compared by its whole sets: members travel to their pivot, which is copied to as many tasks as
its members need.

Defined results: documents without words, and null or blank texts, have no shingles and link with nothing; equal sets
link whatever their texts; rows with one id are one node; a row without an id has no component (null); an empty table
gives an empty result; other columns are ignored. Components are exact; which pairs are compared depends on the data,
so links inside a component are not all listed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import forget, without, written
from .components import components
from .hashing import WordHasher, chunks, grams, mix

WORDS = 4
#: Links need 100 * intersection >= SHARE * union.
SHARE = 85
#: Points of a region that meet pair by pair; larger regions are crowded.
REGION = 32
#: Members of a crowded region that are searched for shingles they share, and how many of all those searched must hold one.
PICKS, REPEATS = 8, 3
#: Shingles that can be moved to the end of the order; the most frequent ones are taken. The order never changes a result.
LATE_SHINGLES = 2_000_000
#: Pivots of a family, and how often regions of more than ``CELL_ROWS`` members are split.
PIVOTS, SPLITS = 4, 4
#: Members compared with one copy of their pivot.
CELL_ROWS = 4_096
#: Written bytes of a table that is sent to every executor; larger ones are joined by shuffle.
SENT_BYTES = 6_000_000
LATE = 1 << 62


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct 62-bit shingle hashes of one text's words; a text of fewer words is one shingle."""
    n = len(hashes)
    if not n:
        return np.zeros(0, dtype=np.int64)
    return np.unique(grams(hashes, min(k, n)) >> np.uint64(2)).astype(np.int64)


def sets_of(texts: list, k: int, hasher: WordHasher) -> Iterator[np.ndarray]:
    for a, b in chunks(texts):
        words, bounds = hasher.words(texts[a:b])
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield shingle_set(words[low:high], k)


def parts(batches: Iterable[pd.DataFrame]) -> Iterator[tuple[np.ndarray, list]]:
    """Ids and texts in pieces of about a million characters, so that a worker's memory does not follow the batch."""
    for batch in batches:
        ids, texts = batch["doc_id"].values, batch["text"].tolist()
        for a, b in chunks(texts):
            yield ids[a:b], texts[a:b]


def fingerprint(found: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over the set."""
    raw = found.astype(np.uint64)
    return (
        int(mix(raw).sum(dtype=np.uint64).astype(np.int64)),
        int(mix(raw ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)),
    )


def n_anchors(n: int, share: int) -> int:
    return n - -(-share * n // 100) + 1


def ordered(found: np.ndarray, late: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The set in the order of its level: hashes, then the late shingles (sorted in ``late``) as ``LATE`` + their rank."""
    if not len(late) or not len(found):
        return found
    at = np.minimum(np.searchsorted(late, found), len(late) - 1)
    return np.sort(np.where(late[at] == found, LATE + rank[at], found))


def described(docs: DataFrame, k: int, share: int, late: np.ndarray, rank: np.ndarray) -> DataFrame:
    """(doc_id, n, f1, f2, anchors): size, fingerprint and first shingles of every document's set."""

    def describe(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for ids, texts in parts(batches):
            rows = []
            for found in sets_of(texts, k, hasher):
                n = len(found)
                rows.append((n, *fingerprint(found), ordered(found, late, rank)[: n_anchors(n, share)].copy() if n else found))
            out = pd.DataFrame(rows, columns=["n", "f1", "f2", "anchors"])
            out.insert(0, "doc_id", ids)
            yield out

    return docs.mapInPandas(describe, "doc_id long, n int, f1 long, f2 long, anchors array<long>")


def sent(table: DataFrame) -> DataFrame:
    """A written table for the small side of a join: sent to all executors if its files are small enough."""
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(table) if int(size) <= SENT_BYTES else table


class Joiner:
    """Links points and keeps their components, until no region holds two that may still link."""

    def __init__(self, docs: DataFrame, points: DataFrame, k: int, share: int):
        """``points`` (p, rep, f1): a number for each distinct set, and the least document that has it."""
        self.docs, self.points, self.k, self.share, self.eps = docs, points, k, share, 1 - share / 100
        self.labels: DataFrame | None = None

    # Conditions on pairs with sizes na and nb

    def near_sizes(self) -> Column:
        return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.share

    def needed(self) -> Column:
        """How many shingles a linked pair of these sizes shares at least."""
        return F.ceil((F.col("na") + F.col("nb")) * self.share / (100 + self.share))

    # Texts

    def texts_of(self, wanted: DataFrame) -> DataFrame:
        """(p, doc_id, text, f1) of the documents that stand for the wanted points (p); ``wanted`` is written."""
        named = written(self.points.join(sent(wanted), "p"), "named")
        return self.docs.join(sent(named).withColumnRenamed("rep", "doc_id"), "doc_id")

    def whole_sets(self, wanted: DataFrame, alone: bool = False) -> DataFrame:
        """(p, shingles) of the wanted points, the sorted set as bytes, or, if asked for, its shingles alone, a row each.
        A task gives a set once, however often its document is repeated."""
        k = self.k

        def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            hasher, seen = WordHasher(), set()
            for batch in batches:
                texts = batch["text"].tolist()
                for a, b in chunks(texts):
                    rows = []
                    for p, f1, found in zip(batch["p"][a:b], batch["f1"][a:b], sets_of(texts[a:b], k, hasher), strict=True):
                        if p not in seen and fingerprint(found)[0] == f1:
                            seen.add(p)
                            rows.append((p, found if alone else found.tobytes()))
                    if rows and alone:
                        yield pd.DataFrame({"shingle": np.concatenate([found for _, found in rows])})
                    elif rows:
                        yield pd.DataFrame(rows, columns=["p", "shingles"])

        schema = "shingle long" if alone else "p long, shingles binary"
        return self.texts_of(wanted).select("p", "f1", "text").mapInPandas(read, schema)

    def compared(self, pairs: DataFrame) -> DataFrame:
        """(a, b, dist, linked) of distinct written pairs, by their whole sets; a is the pivot that b travels to."""
        share = self.share
        sizes = written(pairs.groupBy("a").agg(F.ceil(F.count("*") / CELL_ROWS).alias("cells")), "cells")
        salted = pairs.join(sent(sizes), "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("cells")))
        members = salted.select("a", "salt", F.lit(1).alias("kind"), F.col("b").alias("p"))
        pivots = sizes.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).alias("salt"), F.lit(0).alias("kind"), F.col("a").alias("p"))
        places = written(members.union(pivots), "places")
        wanted = written(places.select("p").distinct(), "wanted")
        dealt = self.whole_sets(wanted).join(sent(places), "p").repartition("a", "salt").sortWithinPartitions("a", "salt", "kind")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pivot, own = None, None
            for batch in batches:
                rows = []
                for a, kind, p, raw in zip(*(batch.column(c).to_pylist() for c in ("a", "kind", "p", "shingles"))):
                    found = np.frombuffer(raw, dtype=np.int64)
                    if kind == 0:
                        pivot, own = a, found
                    elif a == pivot:
                        both = len(np.intersect1d(own, found, assume_unique=True))
                        union = len(own) + len(found) - both
                        rows.append((a, p, 1 - both / union, both * 100 >= union * share))
                columns = list(zip(*rows)) if rows else [[], [], [], []]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["a", "b", "dist", "linked"])

        result = dealt.mapInArrow(compare, "a long, b long, dist double, linked boolean").distinct()
        result = written(result, "distances")
        forget(sizes, places, wanted)
        return result

    # Components

    def link(self, found: DataFrame) -> None:
        """Adds links (a, b) to the components known so far."""
        if not found.limit(1).count():
            return
        if self.labels is not None:
            found = found.union(self.labels.select("node", "component").where("node <> component"))
        last, nodes = self.labels, components(found)
        self.labels = written(nodes, "labels")
        forget(last, nodes)

    def labelled(self, rows: DataFrame, point: str = "p", label: str = "label") -> DataFrame:
        """``rows`` with the component of the point; one that links with nothing is its own."""
        if self.labels is None:
            return rows.withColumn(label, F.col(point))
        met = rows.join(sent(self.labels), F.col(point) == F.col("node"), "left")
        return met.select(*rows.columns, F.coalesce("component", point).alias(label))

    def strangers(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose points are in different components."""
        return self.labelled(self.labelled(pairs, "a", "la"), "b", "lb").where("la <> lb").drop("la", "lb")

    # Regions

    def meet(self, points: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Candidates (a, b) that meet often enough in small regions, and the rows (region, p, n) of crowded regions.

        ``points`` (p, n, anchors) is written. Anchors that no other point has are found by counting, which is combined
        before the shuffle, and only shared ones are looked at again. Regions meet their sizes with the point's number
        only; what else is told of a point follows the shared ones.
        """
        facts = written(points.select("p", "n", F.element_at("anchors", -1).alias("last")), "facts")
        spread = points.select("p", F.explode("anchors").alias("region"))
        counts = written(spread.groupBy("region").agg(F.count("*").alias("size")).where("size > 1"), "region-sizes")
        shared = written(spread.join(sent(counts), "region"), "regions")
        crowded = shared.where(F.col("size") > REGION).join(sent(facts), "p")
        crowded = written(crowded.select("region", "p", "n"), "crowded")
        extra = written(crowded.groupBy("p").agg(F.count("*").alias("extra")), "extra")
        small = shared.where(F.col("size") <= REGION).join(sent(facts), "p").join(sent(extra), "p", "left")
        small = small.withColumn("extra", F.coalesce("extra", F.lit(0)))
        side = lambda s: small.select(
            "region", *[F.col(c).alias(f"{n}{s}") for c, n in (("p", ""), ("n", "n"), ("last", "l"), ("extra", "e"))]
        )
        met = side("a").join(side("b"), "region").where((F.col("a") < F.col("b")) & self.near_sizes())
        same = [F.min(c).alias(c) for c in ("na", "nb", "la", "lb", "ea", "eb")]
        met = met.groupBy("a", "b").agg(F.count("*").alias("meetings"), *same)
        # the point whose anchors end first: each of them that does not meet the other point is a difference
        n = F.when(F.col("la") <= F.col("lb"), F.col("na")).otherwise(F.col("nb"))
        anchors = n - F.ceil(n * self.share / 100) + 1
        enough = F.col("meetings") + F.least("ea", "eb") >= anchors - n + self.needed()
        candidates = written(met.where(enough).select("a", "b"), "candidates")
        forget(facts, counts, shared, extra)
        return candidates, crowded

    def late_shingles(self, crowded: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Shingles that several of a few members of crowded regions hold, sorted, and their ranks by frequency.

        At most ``LATE_SHINGLES`` numbers reach the driver; they decide the order of the next level only.
        """
        by_hash = Window.partitionBy("region").orderBy(F.xxhash64("p"), "p")
        picks = crowded.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= PICKS)
        picks = written(picks.select("p").distinct(), "picks")
        # one Python function a task: with two in a row, an executor keeps twice as many workers from then on
        held = self.whole_sets(picks, alone=True).groupBy("shingle").agg(F.count("*").alias("n"))
        # written first: the shuffle files of a table that is only collected would stay
        held = written(held.where(F.col("n") >= REPEATS), "late")
        late = held.orderBy(F.desc("n"), "shingle").limit(LATE_SHINGLES).toPandas().sort_values(["n", "shingle"])
        forget(picks, held)
        shingles = late["shingle"].to_numpy(dtype=np.int64)
        order = np.argsort(shingles)
        return shingles[order], order.astype(np.int64)

    def anew(self, crowded: DataFrame, late: np.ndarray, rank: np.ndarray) -> DataFrame:
        """(p, n, anchors) of the points of crowded regions, in the order that puts ``late`` shingles last."""
        wanted = written(crowded.select("p").distinct(), "wanted")
        held = self.texts_of(wanted)
        told = described(held.select("doc_id", "text"), self.k, self.share, late, rank)
        # a document may be repeated, and may have another text in another row
        keys = written(self.points.join(sent(wanted), "p"), "keys")
        met = told.join(sent(keys).withColumnRenamed("rep", "doc_id"), ["doc_id", "f1"])
        points = written(met.groupBy("p").agg(F.first("n").alias("n"), F.first("anchors").alias("anchors")), "points")
        forget(wanted, keys)
        return points

    def verify(self, candidates: DataFrame) -> None:
        """Links candidates: first each point with its least partner, then those still in different components."""
        star = written(candidates.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "star")
        found = self.compared(star)
        self.link(found.where("linked").select("a", "b"))
        rest = candidates.join(star, ["a", "b"], "left_anti")
        rest = written(self.strangers(rest), "rest")
        more = self.compared(rest)
        self.link(more.where("linked").select("a", "b"))
        forget(star, found, rest, more)

    def families(self, early: DataFrame, crowded: DataFrame) -> None:
        """Joins the crowded regions that are left by Voronoi regions of their members.

        ``early`` (p, early): how many anchors of a point are no late shingles.
        """
        # anchors in small regions or alone in theirs: no partner has them that is met in crowded regions only
        known = crowded.groupBy("p").agg(F.count_if(F.col("region") < LATE).alias("known"))
        facts = early.join(known, "p").select("p", (F.col("early") - F.col("known")).alias("alone"))
        rows = written(crowded.join(facts, "p").withColumn("cell", F.col("region")), "cells")
        ready = []
        for turn in range(SPLITS):
            last, cells = rows, self.split(rows, turn)
            sizes = cells.groupBy("cell").agg(F.count("*").alias("size"), F.first("whole").alias("whole"))
            # a cell that keeps most of what it was cut from lies within reach of every pivot: pivots of its own only copy it
            large = written(sizes.where((F.col("size") > CELL_ROWS) & (F.col("size") * 2 <= F.col("whole"))).select("cell"), "large")
            if turn == SPLITS - 1 or not large.limit(1).count():
                ready.append(cells)
                forget(last, large)
                break
            ready.append(written(cells.join(sent(large), "cell", "left_anti"), "ready"))
            rows = written(cells.join(sent(large), "cell", "left_semi"), "cells")
            forget(last, cells, large)
        for cells in ready:
            rows = self.contested(cells)
            self.last_pairs(rows)
            forget(cells, rows)

    def contested(self, rows: DataFrame) -> DataFrame:
        """Rows of cells with several components, with their label and the cell's largest component."""
        held = self.labelled(rows)
        counts = held.groupBy("cell", "label").agg(F.count("*").alias("members"))
        state = counts.groupBy("cell").agg(F.max_by("label", F.struct("members", "label")).alias("major"), F.count("*").alias("labels"))
        state = written(state.where("labels > 1").drop("labels"), "contested-cells")
        return written(held.join(sent(state), "cell"), "contested")

    def split(self, rows: DataFrame, turn: int) -> DataFrame:
        """One step of the recursion: rows (cell, whole, pivot, dist, home, ...) of the Voronoi regions of all cells' pivots.

        ``whole`` is the size of the cell that was split, ``home`` tells the region of a member's nearest pivot from those
        that it is copied to. Members that link meet in the home of the one that is nearer to its pivot.
        """
        held = self.contested(rows.select("cell", "region", "p", "n", "alone"))
        # the members with the fewest shingles of their own stand in the middle, where most others are within reach
        central = Window.partitionBy("cell").orderBy("alone", F.xxhash64("p", F.lit(turn)), "p")
        pivots = held.select("cell", "p", "n", "alone").withColumn("place", F.row_number().over(central)).where(F.col("place") <= PIVOTS)
        pivots = written(pivots.select("cell", F.col("p").alias("a"), F.col("n").alias("na")), "pivots")
        whole = held.groupBy("cell").agg(F.count("*").alias("whole"))
        pivots_of = written(pivots.join(whole, "cell"), "pivots-of")
        members = held.drop("label", "major").withColumnsRenamed({"p": "b", "n": "nb"})
        met = written(members.join(sent(pivots_of), "cell").where("a <> b"), "met")
        asked = written(met.where(self.near_sizes()).select("a", "b").distinct(), "asked")
        distances = self.compared(asked)
        self.link(distances.where("linked").select("a", "b"))
        # a distance that was not asked for is at least that of the sizes alone
        by_size = 1 - F.least("na", "nb") / F.greatest("na", "nb")
        known = met.join(distances.drop("linked"), ["a", "b"], "left")
        known = known.withColumn("least", F.coalesce("dist", by_size))
        nearest = F.min(F.struct(F.coalesce("dist", F.lit(1.0)).alias("dist"), "a")).over(Window.partitionBy("cell", "b"))
        inside = known.withColumn("nearest", nearest).where(F.col("least") <= F.col("nearest.dist") + 2 * self.eps + 1e-9)
        # pivots have met all of their cell
        inside = inside.join(sent(pivots.select("cell", F.col("a").alias("b"))), ["cell", "b"], "left_anti")
        inside = inside.select(
            F.xxhash64("cell", "a").alias("cell"), "whole", "region", F.col("b").alias("p"), F.col("nb").alias("n"), "alone",
            F.col("a").alias("pivot"), "dist", "least", (F.col("a") == F.col("nearest.a")).alias("home"),
        )
        state = written(self.labelled(self.labelled(inside), "pivot", "pivot_label"), "state")
        window = state.where("label <> pivot_label").groupBy("cell").agg(F.min("least").alias("edge"))
        stays = (F.col("label") != F.col("pivot_label")) | F.col("dist").isNull() | (F.col("dist") >= F.col("edge") - self.eps - 1e-9)
        kept = state.join(sent(written(window, "edges")), "cell").where(stays)
        result = written(kept.drop("label", "pivot_label", "least", "edge"), "cells")
        forget(held, pivots, pivots_of, met, asked, distances, state)
        return result

    def last_pairs(self, rows: DataFrame) -> None:
        """Compares members outside the largest component of their cell with all members of other components, where
        one of the two is at home.

        Where the crowded regions that a pair shares are all of late shingles, it shares no small region unless it was a
        candidate there, so anchors that are no crowded ones differ for certain. The others travel to as many tasks as
        the members of their cell need.
        """
        sizes = written(rows.groupBy("cell").agg(F.ceil(F.count("*") / CELL_ROWS).alias("salts")), "salts")
        dealt = rows.join(sent(sizes), "cell")
        side = lambda held, s, *more: held.select(
            "cell", F.col("p").alias(s), *[F.col(c).alias(f"{n}{s}") for c, n in (("n", "n"), ("label", "label_"), ("alone", "alone_"), ("dist", "dist_"), ("home", "home_"))], *more,
        )
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")
        few = side(dealt.where("label <> major"), "a", copies)
        every = side(dealt, "b", "region", "major", F.pmod(F.xxhash64("p"), F.col("salts")).alias("salt"))
        # two joins, so that pairs of which neither is at home are not made
        met = every.join(few.where("home_a"), ["cell", "salt"]).union(every.where("home_b").join(few.where("NOT home_a"), ["cell", "salt"]))
        met = met.where("label_a <> label_b AND (label_b = major OR a < b)")
        differ = (F.col("alone_a") <= F.col("na") - self.needed()) & (F.col("alone_b") <= F.col("nb") - self.needed())
        apart = F.coalesce(F.abs(F.col("dist_a") - F.col("dist_b")) <= self.eps + 1e-9, F.lit(True))
        met = met.where(self.near_sizes() & ((F.col("region") < LATE) | differ) & apart)
        pairs = written(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "last-pairs")
        found = self.compared(pairs)
        self.link(found.where("linked").select("a", "b"))
        forget(sizes, pairs, found)


def joined(docs: DataFrame, doc: str = "doc_id", text: str = "text", k: int = WORDS, share: int = SHARE) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (least id reachable by links, itself included)."""
    source = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    none = np.zeros(0, dtype=np.int64)
    sets = written(described(source, k, share, none, none), "sets")
    rows = written(sets.drop("anchors"), "rows")
    key = ["n", "f1", "f2"]
    filled = rows.where("n > 0 and doc_id is not null")
    # the points: one row of each distinct set, numbered
    classes = sets.where("n > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("anchors").alias("anchors"))
    points = written(classes.withColumn("p", F.monotonically_increasing_id()), "points")
    forget(sets)
    names = written(points.select("p", "rep", *key), "names")
    joiner = Joiner(source, names.select("p", "rep", "f1"), k, share)
    member = written(filled.join(names.drop("rep"), key).select("doc_id", "n", "p"), "member")
    # rows with one id are one node, whatever their texts
    several = member.groupBy("doc_id").agg(F.min("p").alias("a"), F.max("p").alias("z")).where("a <> z").drop("z")
    several = written(several, "several")
    joiner.link(written(member.join(sent(several), "doc_id").where("p <> a").select("a", F.col("p").alias("b")).distinct(), "ties"))

    candidates, crowded = joiner.meet(points.select("p", "n", "anchors"))
    forget(points)
    if crowded.limit(1).count():
        again = joiner.anew(crowded, *joiner.late_shingles(crowded))
        more, families = joiner.meet(again)
        early = written(again.select("p", F.size(F.filter("anchors", lambda x: x < LATE)).alias("early")), "early")
        both = written(candidates.union(more).distinct(), "candidates")
        forget(candidates, more, again)
        joiner.verify(both)
        if families.limit(1).count():
            joiner.families(early, families)
        forget(both, early, families)
    else:
        joiner.verify(candidates)
        forget(candidates)
    forget(crowded)

    labels = joiner.labelled(names.select("p", "rep"))
    least = written(labels.groupBy("label").agg(F.min("rep").alias("component_id")), "least")
    of_point = written(labels.join(sent(least), "label").select("p", "component_id"), "of-point")
    linked = member.join(sent(of_point), "p").select("doc_id", "n", "component_id")
    alone = rows.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.union(alone).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, doc: str = "doc_id", **options) -> DataFrame:
    """``docs`` without those that a smaller id of their component stands for, with all their columns."""
    found = joined(docs, doc, **options)
    kept = without(docs, found.where("component_id <> doc_id").select("doc_id"), doc)
    forget(found)
    return kept
