"""The prefix trie against a dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gridtide.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(sequences):
    members, ends = {}, {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
        ends.setdefault(tuple(s), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p, own in members.items():
        for d in range(len(p) + 1):
            above = p[:d]
            leaves[above] = leaves.get(above, 0) + (p not in kids)
            saved[above] = saved.get(above, 0) + ((len(own) - 1) * len(p[-1][1]) if p else 0)
    digest = lambda p: hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()
    return sorted(
        (min(own), len(p), min(members[p[:-1]]) if p else -1, len(own), kids.get(p, 0), leaves[p], saved[p], digest(p)) for p, own in members.items()
    )


def found(df):
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in df.collect())


def make(spark, rows, parts=5):
    clashing = ("c", "j", "name", "n", "m", "prefix", "whole", "size", "place")
    return spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumns({c: F.lit(1) for c in clashing})


def talks(seed, n, turns, words):
    """Few words, so that many prefixes meet; ids with gaps, some negative; nulls."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        c = rng.choice([i, 100 * i, 250 + i, -i])
        for turn in range(rng.randrange(1, turns)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(words)))
    return rows


@pytest.mark.parametrize("seed, n, turns, words", [(1, 60, 9, ["a", "", None, "😀b"]), (2, 25, 40, ["a", "bcd"]), (3, 6, 2, ["x"])])
def test_nodes_equal_a_dictionary(spark, seed, n, turns, words):
    rows = talks(seed, n, turns, words)
    assert found(prefix_trie.rebuilt_trie(make(spark, rows))) == brute(rebuilt(rows))


def test_long_and_equal_conversations(spark, monkeypatch):
    """One conversation holds most rows and is spread over tasks; many others are equal; one extends them."""
    monkeypatch.setattr(prefix_trie, "STRETCH", 16)
    rows = [(700, t, "user", f"t{t % 3}") for t in range(700)]
    rows += [(c, t, "user", "same") for c in range(201, 260) for t in range(7)]
    rows += [(c, t, "user", f"t{t % 3}") for c in (701, 702, 799) for t in range(650)]
    assert found(prefix_trie.rebuilt_trie(make(spark, rows))) == brute(rebuilt(rows))


def test_odd_rows(spark):
    rows = [
        (5, None, "user", "null turn first"), (5, 0, "user", "b"), (5, 0, "user", "a"), (5, 0, "assistant", "z"), (5, 0, "user", "a"),
        (None, 0, "user", "no conversation"), (7, 0, None, None), (8, 0, "", ""), (101, 0, "user", "base is absent"), (302, 0, "x", "y" * 200_000),
        (300, 1, "x", "base"), (300, 2, "x", "base"),
    ]
    assert found(prefix_trie.rebuilt_trie(make(spark, rows))) == brute(rebuilt(rows))
    nothing = prefix_trie.rebuilt_trie(make(spark, rows).limit(0))
    assert nothing.collect() == [] and nothing.columns[:3] == ["conv_id", "depth", "parent_conv_id"]
    assert prefix_trie.rebuilt_trie(make(spark, [(None, 0, "a", "b")])).collect() == []


def test_only_turnless_conversations(spark):
    ids = [c for c in range(1, 400) if zlib.crc32(str(c).encode()) % 6 > 0 and c % 100][:20]
    rows = [(c, 0, "user", "lost") for c in ids]
    assert found(prefix_trie.rebuilt_trie(make(spark, rows))) == brute(rebuilt(rows))


def test_halves_not_steps(spark):
    """The number of levels grows with the logarithm of the longest sequence."""
    rows = spark.range(1000).select(F.lit(1).cast("long").alias("c"), F.col("id").alias("j"), prefix_trie.name_of(b"t", F.col("id").cast("string")).alias("name"), F.lit(1).alias("size"), F.lit(1000).cast("long").alias("len"))
    assert len(prefix_trie.named_blocks(rows)) == 11
