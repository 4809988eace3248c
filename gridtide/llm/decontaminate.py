"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items meet through shared seeds: runs of ``min_match`` words. For each document and item that
share enough of them, the longest common runs that do not overlap earlier ones are marked as tiles, longest first, by
running Karp-Rabin matching; the tiled share of the item is its coverage. As tiles may stand in any order, an item
whose sentences were moved is still found. Coverage cannot exceed the share of item words inside shared seeds, so
pairs whose seeds cover too little are dismissed before tiling, exactly.

The benchmark is read in blocks of bounded size, each sent to the executors while they read the documents once.

Defined results: null and blank texts share nothing; words are compared in lower case; items with fewer than
``min_match`` words prove nothing and are never found; repeated documents and items are each reported; an empty table
on either side gives an empty result; other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import without
from .hashing import WordHasher, chunks, grams

MIN_MATCH = 5
MIN_COVERAGE = 0.5
BLOCK_CHARS = 8_000_000
RESULT = "item_id long, covered_words int, item_words int, n_tiles int, coverage double"


def tiles(text: Sequence, item: Sequence, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling by running Karp-Rabin: (place in text, place in item, length), in order of marking.

    Each round hashes all unmarked windows of the search length. A common run of more than twice that length starts
    the round again with its length; otherwise the matches are marked from the longest down, those that overlap an
    earlier tile are dropped (their free parts return in a later, shorter round), and the search length is halved.
    Equally long matches are marked by their places in text, then item.
    """
    text_free, item_free = bytearray(b"\1" * len(text)), bytearray(b"\1" * len(item))
    found: list[tuple[int, int, int]] = []
    length = max(min_match, min(len(item), 4 * min_match))
    while True:
        matches, longest = _matches(text, item, text_free, item_free, length)
        if longest > 2 * length:
            length = longest
            continue
        for size, t, i in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if size >= length and all(text_free[t : t + size]) and all(item_free[i : i + size]):
                text_free[t : t + size] = item_free[i : i + size] = bytes(size)
                found.append((t, i, size))
        again, longest = _matches(text, item, text_free, item_free, length)
        if again:
            continue
        if length == min_match:
            return found
        length = max(min_match, length // 2)


def _matches(text, item, text_free, item_free, length) -> tuple[list[tuple[int, int, int]], int]:
    """Maximal unmarked common runs of at least ``length``, and the length of the longest."""
    windows: dict[int, list[int]] = defaultdict(list)
    for i, h in _rolling(item, item_free, length):
        windows[h].append(i)
    matches, longest, ended = [], 0, {}
    for t, h in _rolling(text, text_free, length):
        for i in windows.get(h, ()):
            if ended.get(i - t, -1) > t:  # inside a run on the same diagonal that is already listed
                continue
            size = 0
            while (
                t + size < len(text) and i + size < len(item)
                and text_free[t + size] and item_free[i + size] and text[t + size] == item[i + size]
            ):
                size += 1
            if size >= length:
                matches.append((size, t, i))
                ended[i - t] = t + size
                longest = max(longest, size)
    return matches, longest


def _rolling(words: Sequence[int], free: bytearray, length: int) -> Iterator[tuple[int, int]]:
    """Karp-Rabin hashes of the windows whose words are all unmarked."""
    base, mod = 1_000_003, (1 << 61) - 1
    top = pow(base, length - 1, mod)
    value, run = 0, 0
    for at, w in enumerate(words):
        if not free[at]:
            value, run = 0, 0
            continue
        if run == length:
            value = (value - words[at - length] * top) % mod
            run -= 1
        value = (value * base + w) % mod
        run += 1
        if run == length:
            yield at - length + 1, value


class Index:
    """The seeds of one block of items: sorted seed hashes with the items and places they stand at."""

    def __init__(self, items: Sequence[tuple[int, str]], min_match: int):
        self.min_match = min_match
        hasher = WordHasher(lower=False)
        self.items = []
        seeds, owner, place = [], [], []
        for item_id, text in items:
            hashes, _ = hasher.words([(text or "").lower()])
            if len(hashes) < min_match:
                continue
            g = grams(hashes, min_match)
            seeds.append(g)
            owner.append(np.full(len(g), len(self.items)))
            place.append(np.arange(len(g)))
            self.items.append((item_id, hashes))
        if not self.items:
            self.seeds = np.zeros(0, dtype=np.uint64)
            return
        seeds, owner, place = map(np.concatenate, (seeds, owner, place))
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owner, self.place = seeds[order], owner[order], place[order]
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[self.seeds & np.uint64((1 << 20) - 1)] = True

    def hits(self, g: np.ndarray) -> np.ndarray:
        """Places of ``g`` that hold a seed."""
        maybe = np.flatnonzero(self.filter[g & np.uint64((1 << 20) - 1)])
        at = np.searchsorted(self.seeds, g[maybe])
        return maybe[(at < len(self.seeds)) & (self.seeds[np.minimum(at, len(self.seeds) - 1)] == g[maybe])]

    def compare(self, words: np.ndarray, g: np.ndarray, hits: np.ndarray, min_coverage: float) -> Iterator[tuple]:
        """Rows of ``RESULT`` for one document, given where its seeds stand."""
        k = self.min_match
        distinct = np.unique(g[hits])
        low, high = np.searchsorted(self.seeds, distinct, "left"), np.searchsorted(self.seeds, distinct, "right")
        at = np.concatenate([np.arange(a, b) for a, b in zip(low, high, strict=True)])
        # the document, cut to words inside seeds; a number of its own stands for what is cut out
        inside = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(inside, hits, 1)
        np.add.at(inside, np.minimum(hits + k, len(words)), -1)
        inside = np.cumsum(inside[:-1]) > 0
        starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
        cut = []
        for n, s in enumerate(starts):
            e = s
            while e < len(words) and inside[e]:
                e += 1
            cut += [int(x) for x in words[s:e] >> np.uint64(4)]
            cut.append(-n - 1)
        for number in np.unique(self.owner[at]):
            item_id, item = self.items[number]
            covered = np.zeros(len(item), dtype=bool)
            for p in self.place[at[self.owner[at] == number]]:
                covered[p : p + k] = True
            if covered.sum() < min_coverage * len(item):
                continue
            marked = tiles(cut, [int(x) for x in item >> np.uint64(4)], k)
            total = sum(size for *_, size in marked)
            if total >= min_coverage * len(item):
                yield item_id, total, len(item), len(marked), total / len(item)


def blocks(benchmark: DataFrame, item: str, text: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in parts that are small enough to send to every executor."""
    sized = benchmark.select(F.col(item).cast("long").alias("item_id"), F.col(text).alias("text"))
    total = sized.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-total // block_chars))
    for part in range(parts):
        held = sized if parts == 1 else sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield [(r.item_id, r.text) for r in held.collect()]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    min_match: int = MIN_MATCH,
    min_coverage: float = MIN_COVERAGE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and item whose tiles cover at least ``min_coverage`` of the item's words."""
    spark = docs.sparkSession
    source = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id long, {RESULT}"
    out = None
    for block in blocks(benchmark, item, item_text, block_chars):
        index = Index(block, min_match)
        if not len(index.seeds):
            continue
        shared = spark.sparkContext.broadcast(index)

        def compare(batches: Iterable[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            hasher, index = WordHasher(lower=False), shared.value
            for batch in batches:
                ids, texts = batch["doc_id"].tolist(), batch["text"].tolist()
                rows = []
                for a, b in chunks(texts):
                    rows += _chunk(index, hasher, ids[a:b], texts[a:b], min_coverage)
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

        found = source.mapInPandas(compare, schema)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def _chunk(index: Index, hasher: WordHasher, ids: list, texts: list, min_coverage: float) -> list[tuple]:
    words, bounds = hasher.words([t.lower() if t else "" for t in texts])
    g = grams(words, index.min_match)
    hits = index.hits(g) if len(g) else np.zeros(0, dtype=np.int64)
    rows = []
    low, high = np.searchsorted(hits, bounds[:-1]), np.searchsorted(hits, bounds[1:] - index.min_match, "right")
    for n in np.flatnonzero(high > low):
        a, b = bounds[n], bounds[n + 1]
        own = hits[low[n] : high[n]] - a
        doc_id = None if pd.isna(ids[n]) else int(ids[n])
        rows += [(doc_id, *row) for row in index.compare(words[a:b], g[a:b], own, min_coverage)]
    return rows


def clean(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", **options) -> DataFrame:
    """The documents that cover no benchmark item, with all their columns; rows without an id stay."""
    return without(docs, contaminated(docs, benchmark, doc=doc, **options).select("doc_id"), doc)
