"""Token ids as grammar-compressed binary shards that can be decoded one document at a time.

Documents are dealt by ranges of their id, so shards follow each other in ascending id order. A task encodes its
documents and cuts them into shards of about ``SHARD_TOKENS`` ids. Each shard is compressed by Re-Pair: frequent
neighbouring pairs are replaced by new symbols, round by round; no pair crosses the end of a document. A shard is one
row of a Parquet file, so it is written and committed by Spark:

``part``, ``seq``      place of the shard: parts follow in id order, shards of a part by ``seq``
``n_docs``, ``n_tokens``  documents and ids in it
``doc_ids``            int64 per document; ``null_ids`` marks, one byte each, documents without an id
``doc_tokens``         uint32 per document: how many ids
``doc_symbols``        uint32 per document: how many symbols of the stream
``rules``              uint16 pairs: rule k stands for symbol ``FIRST + k``
``rule_tokens``        uint32 per rule: how many ids it expands to
``stream``             uint16 symbols

All numbers are little-endian. A reader finds a document by summing ``doc_symbols`` and expands only its own symbols.

Encoding goes by distinct words. The tokenizer first cuts a text into runs of letters, single digits and runs of other
characters, each encoded on its own, so every distinct run is encoded once and the rest is lookup. A Python worker keeps
the runs it has learned, up to a bound, for its next task. Texts where a run depends on its surroundings (apostrophes,
special tokens, letters that normalisation joins or whose lower case depends on their place) are encoded whole.

Defined results: a null or empty text is the end id alone; equal documents follow each other in unspecified order;
documents without an id come first; an empty table gives no shard and an empty index; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import new_folder, writing, written
from .hashing import BASE, chunks, mix

END = 2
FIRST = 49408
#: Ids of a shard, about: compressing one takes some fifty bytes an id. Characters of a task: an executor sorts them and
#: holds what it fetches of them.
SHARD_TOKENS = 1_000_000
PART_CHARS = 24_000_000
#: Distinct runs whose ids a worker remembers, some thirty bytes each, and ids of a run on average at most; then it forgets
#: them all and learns anew. So many of them are kept apart before they are sorted into the others.
CACHE_RUNS, RUN_IDS = 1_000_000, 8
LATE_RUNS = 1 << 16
#: Characters whose runs are looked up together: the more, the fewer are looked up twice.
PIECE = 1 << 18
#: Parts whose starts are summed in one task at a time.
PART_BLOCK = 1_000
RULES_A_ROUND = 4000
MIN_COUNT = 8
RARE = re.compile("[^\\u0000-\\u2fff]")
UNSAFE = ("'", "<|", "Σ", "İ")
BLANKS = (0x20, 0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, *range(9, 14), *range(0x2000, 0x200B))
SHARD = (
    "part int, seq int, n_docs int, n_tokens long, doc_ids binary, null_ids binary, doc_tokens binary, "
    "doc_symbols binary, rules binary, rule_tokens binary, stream binary"
)


class Growing:
    """An array that is appended to."""

    def __init__(self, kind: type):
        self.data, self.n = np.empty(1 << 12, dtype=kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.data):
            data = np.empty(max(self.n + len(more), 2 * len(self.data)), dtype=self.data.dtype)
            data[: self.n] = self.data[: self.n]
            self.data = data
        self.data[self.n : self.n + len(more)] = more
        self.n += len(more)


def added(table: tuple[np.ndarray, np.ndarray], hashes: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A table of (sorted hashes, their slots) with further ones, sorted as well."""
    place = np.searchsorted(table[0], hashes)
    return np.insert(table[0], place, hashes), np.insert(table[1], place, slots)


class Encoder:
    """Encodes many texts at once; equal to the tokenizer's own result for each text."""

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        kinds = {"L": 1, "N": 2}
        self.kind = np.array([kinds.get(unicodedata.category(chr(c))[0], 3) for c in range(0x3000)], dtype=np.uint8)
        self.kind[[b for b in BLANKS if b < len(self.kind)]] = 0
        self.powers = self.inverse = np.ones(1, dtype=np.uint64)
        self.forget()

    def forget(self) -> None:
        """Empties the cache of runs."""
        none = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)
        self.known, self.late = none, none
        self.flat, self.size, self.start = Growing(np.uint16), Growing(np.int32), Growing(np.int64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            for name, base in (("powers", BASE), ("inverse", pow(BASE, -1, 1 << 64))):
                steps = np.full(n + n // 8, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, out=steps))

    def whole(self, texts: Sequence[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint16) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Ids of new runs; many are encoded as one text, and each ends with a token that ends a word."""
        groups = [new[i : i + 200] for i in range(0, len(new), 200)]
        for group in groups:
            (ids,) = self.whole([" ".join(group)])
            stops = np.flatnonzero(self.ends[ids]) + 1
            parts = self.whole(group) if len(stops) != len(group) or stops[-1] != len(ids) else None
            sizes = np.diff(stops, prepend=0) if parts is None else np.array([len(p) for p in parts])
            self.start.add(self.flat.n + np.cumsum(sizes) - sizes)
            self.size.add(sizes)
            self.flat.add(ids if parts is None else np.concatenate(parts))

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        """Where the ids of the runs with these hashes are; -1 for unknown ones."""
        slots = np.full(len(hashes), -1, dtype=np.int32)
        for known, numbers in (self.known, self.late):
            place = np.searchsorted(known, hashes)
            seen = place < len(known)
            seen[seen] = known[place[seen]] == hashes[seen]
            slots[seen] = numbers[place[seen]]
        return slots

    def _by_runs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = "\n".join(texts) + "\n"
        data = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = self.kind[data]
        first = np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] == 2))) & (kind > 0)
        starts = np.flatnonzero(first)
        ends = np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] == 2), [True]))
        ends = np.flatnonzero(ends[1:] & (kind > 0)) + 1
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        self._reach(len(data))
        np.cumsum(mix(data.astype(np.uint64) + np.uint64(BASE)) * self.powers[: len(data)], out=sums[1:])
        found = mix((sums[ends] - sums[starts]) * self.inverse[starts])
        order = np.argsort(found)  # any place of a run will do, so the sort need not be stable as in np.unique
        found = found[order]
        head = np.ones(len(found), dtype=bool)
        head[1:] = found[1:] != found[:-1]
        hashes, at = found[head], order[head]
        inverse = np.empty(len(found), dtype=np.int64)
        inverse[order] = np.cumsum(head) - 1
        slots = self._slots(hashes)
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = self.size.n + np.arange(len(new))
            self._learn([text[a:b] for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist())])
            self.late = added(self.late, hashes[new], slots[new])
            if len(self.late[0]) > LATE_RUNS:
                self.known, self.late = added(self.known, *self.late), tuple(x[:0].copy() for x in self.late)
        run = slots[inverse]
        sizes = self.size.data[run]
        stops = np.cumsum(sizes, dtype=np.int64)
        n = int(stops[-1]) if len(stops) else 0
        ids = self.flat.data[np.repeat(self.start.data[run] - stops + sizes, sizes) + np.arange(n)]
        offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        return ids, np.concatenate(([0], stops))[np.searchsorted(starts, offsets)]

    def _looked_up(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.size.n > CACHE_RUNS or self.flat.n > CACHE_RUNS * RUN_IDS:
            self.forget()
        return self._by_runs(texts)

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        plain, whole = [], []
        for n, t in enumerate(texts):
            t = t or ""
            if t.isascii() or not (RARE.search(t) or not unicodedata.is_normalized("NFC", t)):
                ordinary = not any(u in t for u in UNSAFE)
            else:
                ordinary = False
            (plain if ordinary else whole).append(n)
        lowered = [(texts[n] or "").lower() for n in plain]
        for a, b in chunks(lowered, PIECE):
            if len(lowered[a]) > PIECE:  # a long text stands alone
                out[plain[a]] = np.concatenate([self._looked_up([piece])[0] for piece in pieces(lowered[a])])
                continue
            ids, bounds = self._looked_up(lowered[a:b])
            for n, low, high in zip(plain[a:b], bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                out[n] = ids[low:high]
        for n in whole:
            (out[n],) = self.whole([texts[n]])
        return out


def pieces(text: str) -> Iterator[str]:
    """A long text in pieces of about ``PIECE`` characters, cut behind blanks or line ends, where every run ends."""
    at = 0
    while at < len(text):
        end = at + PIECE
        cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
        if end < len(text) and cut < at:
            cut = min((x for x in (text.find(" ", end), text.find("\n", end)) if x >= 0), default=len(text))
        end = cut + 1 if end < len(text) else end
        yield text[at:end]
        at = end


@lru_cache(maxsize=1)
def worker_encoder(tokenizer_path: str) -> Encoder:
    """One encoder for all tasks of a Python worker, with the runs it knows; ``cache_clear`` gives its memory back."""
    return Encoder(tokenizer_path)


def compress(ids: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair: (rules, stream, which symbols end a document). ``last`` marks the ids that end a document.

    A round counts all pairs inside documents, takes the most frequent ones (ties by pair) as rules, and replaces
    their places from left to right; where replaced pairs would overlap, the first one is taken. Rounds
    end when no pair occurs ``MIN_COUNT`` times or 16 bits hold no further symbol.
    """
    symbols, rules = ids.astype(np.uint32), []
    n_rules = fresh = 0
    while True:
        room = min(RULES_A_ROUND, (1 << 16) - FIRST - n_rules)
        if len(symbols) < 2 or room <= 0:
            break
        inside = ~last[:-1]
        if fresh:  # all frequent pairs of older symbols are replaced already: only new symbols make new ones
            inside &= (symbols[:-1] >= fresh) | (symbols[1:] >= fresh)
        pairs = symbols[:-1] << np.uint32(16)
        pairs |= symbols[1:]
        pairs = pairs[inside]
        counted = np.sort(pairs)
        edge = np.flatnonzero(np.concatenate(([True], counted[1:] != counted[:-1]))) if len(counted) else np.zeros(0, int)
        counts = np.diff(np.append(edge, len(counted)))
        often = np.flatnonzero(counts >= MIN_COUNT)
        if not len(often):
            break
        if len(often) <= room:
            fresh = FIRST + n_rules
        often = often[np.argsort(-counts[often], kind="stable")[:room]]
        chosen = np.sort(counted[edge[often]])
        del counted, edge, counts
        maybe = np.zeros(1 << 20, dtype=bool)
        slot = lambda p: (p * np.uint32(0x9E3779B1)) >> np.uint32(12)
        maybe[slot(chosen)] = True
        hit = maybe[slot(pairs)]
        found = pairs[hit]
        inside[inside] = hit
        at = np.flatnonzero(inside)
        del pairs, hit
        rule = np.searchsorted(chosen, found)
        true = chosen[np.minimum(rule, len(chosen) - 1)] == found
        at, rule = at[true], rule[true]
        # of places that follow each other directly, every second one
        gap = np.concatenate(([True], np.diff(at) > 1))
        run_start = np.maximum.accumulate(np.where(gap, np.arange(len(at)), 0))
        take = (np.arange(len(at)) - run_start) % 2 == 0
        at, rule = at[take], rule[take]
        symbols[at] = FIRST + n_rules + rule
        last[at] = last[at + 1]
        keep = np.ones(len(symbols), dtype=bool)
        keep[at + 1] = False
        symbols, last = symbols[keep], last[keep]
        rules.append(np.stack([chosen >> np.uint32(16), chosen & np.uint32(0xFFFF)], axis=1).astype("<u2"))
        n_rules += len(chosen)
    return np.concatenate(rules) if rules else np.zeros((0, 2), "<u2"), symbols.astype("<u2"), last


def rounds(rules: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rules that stand for symbols of earlier ranges and ids only."""
    newest = rules.max(axis=1).astype(np.int64) - FIRST
    done = 0
    while done < len(rules):
        later = np.flatnonzero(newest[done:] >= done)
        stop = done + int(later[0]) if len(later) else len(rules)
        yield done, stop
        done = stop


def rule_lengths(rules: np.ndarray) -> np.ndarray:
    size = np.ones(FIRST + len(rules), dtype="<u4")
    for a, b in rounds(rules):
        size[FIRST + a : FIRST + b] = size[rules[a:b]].sum(axis=1)
    return size[FIRST:]


class Grammar:
    """Expands symbols of one shard."""

    def __init__(self, rules: np.ndarray, rule_tokens: np.ndarray):
        self.size = np.concatenate([np.ones(FIRST, dtype=np.int64), rule_tokens.astype(np.int64)])
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.empty(int(self.size.sum()), dtype=np.uint16)
        self.flat[:FIRST] = np.arange(FIRST)
        for a, b in rounds(rules):
            ids = self.expand(rules[a:b].ravel())
            low = self.start[FIRST + a]
            self.flat[low : low + len(ids)] = ids

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        sizes = self.size[symbols]
        stops = np.cumsum(sizes)
        return self.flat[np.repeat(self.start[symbols] - stops + sizes, sizes) + np.arange(stops[-1] if len(stops) else 0)]


def pack(part: int, seq: int, doc_ids: list, ids: list[np.ndarray]) -> tuple:
    """One row of the file format."""
    tokens = np.array([len(x) for x in ids], dtype="<u4")
    joined = np.concatenate(ids)
    last = np.zeros(len(joined), dtype=bool)
    last[np.cumsum(tokens) - 1] = True
    rules, stream, last = compress(joined, last)
    symbols = np.diff(np.flatnonzero(last), prepend=-1).astype("<u4")
    missing = np.array([d is None for d in doc_ids], dtype=np.uint8)
    numbers = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    blobs = (numbers, missing, tokens, symbols, rules, rule_lengths(rules), stream)
    return part, seq, len(ids), len(joined), *(b.tobytes() for b in blobs)


def encode_shards(
    docs: DataFrame, path: str, tokenizer: str, doc: str = "doc_id", text: str = "text",
    shard_tokens: int = SHARD_TOKENS, part_chars: int = PART_CHARS,
) -> None:
    """Writes the documents as shards below ``path``.

    Rows are dealt by id and place, so many rows with one id, or without any, are still spread over tasks.
    """
    source = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    total = source.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    order = [F.col("doc_id").asc_nulls_first(), F.col("place")]
    placed = source.withColumn("place", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(max(1, -(-total // part_chars)), *order)

    def shards(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, part, seq = worker_encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids, ids, held = [], [], 0

        def row() -> pd.DataFrame:
            return pd.DataFrame([pack(part, seq, doc_ids, ids)], columns=[c.split()[0] for c in SHARD.split(", ")])

        end = np.array([END], dtype=np.uint16)
        for batch in batches:
            numbers = [None if pd.isna(x) else int(x) for x in batch["doc_id"]]
            texts = batch["text"].tolist()
            for a, b in chunks(texts, 4 * PIECE):
                for number, found in zip(numbers[a:b], encoder.encode(texts[a:b]), strict=True):
                    doc_ids.append(number)
                    ids.append(np.concatenate([found, end]))
                    held += len(found) + 1
                    if held >= shard_tokens:
                        yield row()
                        doc_ids, ids, held, seq = [], [], 0, seq + 1
        if ids:
            yield row()

    ordered = dealt.sortWithinPartitions(*order).select("doc_id", "text")
    with writing(docs.sparkSession):
        ordered.mapInPandas(shards, SHARD).write.parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, seq, shard_start): the ids of all shards before each one.

    Summed within parts, over the parts of a block, and over the blocks, so that no task sees all shards or all parts.
    """
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = shards.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens")).withColumn("block", F.floor(F.col("part") / PART_BLOCK))
    blocks = sums.groupBy("block").agg(F.sum("part_tokens").alias("block_tokens"))
    blocks = blocks.select("block", F.coalesce(F.sum("block_tokens").over(before(Window.orderBy("block"))), F.lit(0)).alias("block_start"))
    in_block = F.coalesce(F.sum("part_tokens").over(before(Window.partitionBy("block").orderBy("part"))), F.lit(0))
    parts = sums.select("part", "block", in_block.alias("part_start")).join(blocks, "block")
    in_part = F.coalesce(F.sum("n_tokens").over(before(Window.partitionBy("part").orderBy("seq"))), F.lit(0))
    placed = shards.select("part", "seq", in_part.alias("start")).join(parts, "part")
    return placed.select("part", "seq", (F.col("start") + F.col("part_start") + F.col("block_start")).alias("shard_start"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Decodes every document: its place in the whole id sequence, its length and the checksum of its ids."""
    shards = spark.read.parquet(path)
    starts = written(shard_starts(shards.select("part", "seq", "n_tokens")), "starts")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, n_symbols long"

    def decode(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker_encoder.cache_clear()  # the workers that encoded are the ones that decode
        for batch in batches:
            for shard in batch.itertuples():
                yield decoded(shard)

    return shards.join(starts, ["part", "seq"]).mapInPandas(decode, schema)


def decoded(shard) -> pd.DataFrame:
    tokens = np.frombuffer(shard.doc_tokens, "<u4").astype(np.int64)
    symbols = np.frombuffer(shard.doc_symbols, "<u4").astype(np.int64)
    grammar = Grammar(np.frombuffer(shard.rules, "<u2").reshape(-1, 2), np.frombuffer(shard.rule_tokens, "<u4"))
    ids = grammar.expand(np.frombuffer(shard.stream, "<u2")).astype("<u4")
    stops = np.cumsum(tokens)
    view = memoryview(ids).cast("B")
    sums = [zlib.crc32(view[4 * (b - n) : 4 * b]) for n, b in zip(tokens.tolist(), stops.tolist(), strict=True)]
    numbers = pd.array(np.frombuffer(shard.doc_ids, "<i8"), dtype="Int64")
    numbers[np.frombuffer(shard.null_ids, np.uint8).astype(bool)] = pd.NA
    return pd.DataFrame(
        {"doc_id": numbers, "start": shard.shard_start + stops - tokens, "n_tokens": tokens, "ids_crc32": sums, "n_symbols": symbols}
    )


def decode_document(shard, place: int) -> np.ndarray:
    """The ids of one document of a shard, without expanding the others."""
    symbols = np.frombuffer(shard.doc_symbols, "<u4").astype(np.int64)
    stop = int(symbols[: place + 1].sum())
    grammar = Grammar(np.frombuffer(shard.rules, "<u2").reshape(-1, 2), np.frombuffer(shard.rule_tokens, "<u4"))
    return grammar.expand(np.frombuffer(shard.stream, "<u2")[stop - int(symbols[place]) : stop])


def encoded(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Writes the shards to the shared folder and returns what ``read_index`` finds in them."""
    path = new_folder(docs.sparkSession, "token-shards")
    encode_shards(docs, path, tokenizer, **options)
    return read_index(docs.sparkSession, path)
