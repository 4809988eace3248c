"""Vector codes against a plain Lloyd loop."""

import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from gridtide.llm import vector_codes as codes


def brute(rows, parts=16, entries=64, rounds=2):
    """rows: (vec_id, label, vector); all Python integers."""
    good = [r for r in rows if r[2] and all(x is not None and math.isfinite(x) for x in r[2]) and len(r[2]) % parts == 0]
    dims = min((r[0], len(r[2])) for r in good if r[0] is not None)[1]
    good = [(i, g, [math.floor(256 * x) for x in v]) for i, g, v in good if len(v) == dims]
    q = dims // parts
    least = {}
    for i, _, v in good:
        if i is not None:
            least[i] = min(v, least.get(i, v))
    books = [[least[i][p * q : (p + 1) * q] for i in sorted(least)[:entries]] for p in range(parts)]

    def put(v, p):
        away = [sum((a - b) ** 2 for a, b in zip(v[p * q : (p + 1) * q], c)) for c in books[p]]
        return away.index(min(away)), min(away)

    for _ in range(rounds):
        members = {}
        for _, _, v in good:
            for p in range(parts):
                members.setdefault((p, put(v, p)[0]), []).append(v[p * q : (p + 1) * q])
        for (p, e), own in members.items():
            books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    found = [(i, g, [put(v, p) for p in range(parts)]) for i, g, v in good]
    total = {}
    for _, g, best in found:
        total[g] = total.get(g, 0) + sum(d for _, d in best)
    return sorted(
        ((i, "".join(f"{e:02x}" for e, _ in best), sum(d for _, d in best), total[g], digest) for i, g, best in found), key=str
    )


def make(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns(
        {c: F.lit(1) for c in ("vector", "entry", "salt", "part", "code", "of")}
    )


def crowd(seed, n, dims=32):
    """A third of all rows are one vector; the rest lie around a few centres."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = []
    for i in range(n):
        near = centres[0] if i % 3 == 0 else [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]
        rows.append((1000 - i, rng.choice([None, 1, 2, 2, 2]), near))
    return rows


def test_codes_equal_plain_rounds(spark, monkeypatch):
    monkeypatch.setattr(codes, "OWNER_ROWS", 16)  # several salts
    monkeypatch.setattr(codes, "BLOCK", 7)
    rows = crowd(1, 200)
    for rounds in (0, 1, 2, 4):
        found = codes.coded(make(spark, rows), entries=16, rounds=rounds)
        assert sorted(map(tuple, found.collect()), key=str) == brute(rows, entries=16, rounds=rounds)


def test_odd_vectors(spark):
    v = [i / 7 - 2 for i in range(16)]
    rows = crowd(2, 40, 16) + [
        (5, 1, None), (6, 1, []), (7, 1, [None] + v[1:]), (8, 1, [math.nan] + v[1:]), (9, 1, [math.inf] + v[1:]), (10, 1, [-math.inf] + v[1:]),
        (2000, 1, v[:8]), (2001, 1, v * 2), (2002, None, v), (2002, None, v), (2003, 7, [x * 1e5 for x in v]), (None, 3, v), (3, 1, v), (3, 1, [-x for x in v]),
    ]
    found = sorted(map(tuple, codes.coded(make(spark, rows)).collect()), key=str)
    assert found == brute(rows) and len(found) == 40 + 6
    assert codes.coded(make(spark, rows).limit(0)).collect() == []
    assert codes.coded(make(spark, [(None, 1, v), (4, 1, None)])).collect() == []
    assert codes.coded(make(spark, [(4, None, v)])).collect() == [tuple(brute([(4, None, v)])[0])]


def test_huge_components_are_clamped(spark):
    rows = [(i, 0, [1e300 if j == i else -3e38 for j in range(16)]) for i in range(4)]
    found = codes.coded(make(spark, rows), entries=2).collect()
    assert len(found) == 4 and all(r.error >= 0 for r in found)


def test_labels_beyond_the_broadcast(spark):
    coded = spark.createDataFrame([(1, None, "a", 3), (2, None, "b", 4), (3, 1, "a", 5), (4, 1, "a", 6)], "vec_id long, label int, code string, error long")
    for limit in (0, 10):
        found = {r.vec_id: r.label_error for r in codes.with_label_error(coded, limit).collect()}
        assert found == {1: 7, 2: 7, 3: 11, 4: 11}


def test_only_changed_members_move(spark, capsys):
    """Members that keep their entry are read from their files, not from a shuffle."""
    rng = np.random.default_rng(3)
    rows = [(i, 0, rng.normal(size=16).tolist()) for i in range(300)]
    kept = make(spark, rows).select("vec_id", F.col("embedding").alias("v"))
    layout = codes.Layout(16, 16, 256)
    books = codes.first_books(kept, "vec_id", "v", layout, 8)
    members = codes.written(codes.at_owners(codes.first_members(kept, "v", layout, books, 3)))
    told = codes.written(codes.reassigned(members, codes.updated(members, books)))
    assert 0 < told.where("target <> entry").count() < told.count() / 2
    told.where("target = entry").explain()
    assert "Exchange" not in capsys.readouterr().out
