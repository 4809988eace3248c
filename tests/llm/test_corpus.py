"""Near copies, leaks, mixing, sharding, token shards and the pipeline against brute force and round trips."""

import random
import re
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridtide.llm import components, decontaminate, jaccard_join, mixing, queries, sharding, token_output
from gridtide.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def brute_components(rows, share=85, k=4):
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t, k)) for i, t in rows]
    for n, (a, s) in enumerate(sets):
        for b, t in sets[:n]:
            if s and t and 100 * len(s & t) >= share * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def crowded(seed, n):
    """Copies with a few changed words, unlike texts around one passage, and short texts of it."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(14)]
    base = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(n):
        kind = i % 3
        if kind == 0:
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(60)] = rng.choice(vocabulary)
        elif kind == 1:
            words = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 40))]
            words[3:3] = passage
        else:
            words = passage + [rng.choice(vocabulary) for _ in range(rng.randrange(4))]
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("region, seed", [(2, 1), (2, 2), (6, 3), (32, 4)])
def test_join_equals_brute_force_on_crowded_regions(spark, monkeypatch, region, seed):
    for name, value in (("REGION", region), ("PICKS", 3), ("REPEATS", 2), ("PIVOTS", 2), ("CELL_ROWS", 8)):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = crowded(seed, 120)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute_components(rows)


def test_families_are_joined_exactly(spark, monkeypatch):
    """Near copies at all distances from each other around several texts, so that regions split and windows matter."""
    for name, value in (("REGION", 3), ("PIVOTS", 2), ("SENT_BYTES", 0), ("CELL_ROWS", 8)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(9)
    bases = [[f"v{rng.randrange(80)}" for _ in range(40)] for _ in range(2)]
    rows = []
    for i in range(90):
        words = list(bases[i % 2])
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(3)] = [f"v{rng.randrange(80)}" for _ in range(rng.randrange(3))]
        rows.append((i, " ".join(words)))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    expected = brute_components(rows)
    assert found == expected and 3 < len({c for _, c in expected.values()}) < 80


def test_a_family_within_reach_of_every_pivot_is_copied_once(spark, monkeypatch):
    """Pivots of its own do not part a large family: it is dealt out to the regions of one set of pivots and not again."""
    made = []

    def spied(df, name="step", write=jaccard_join.written):
        out = write(df, name)
        if name in ("crowded", "cells", "met"):
            made.append((name, out.count()))
        return out

    for name, value in (("REGION", 3), ("PIVOTS", 3), ("CELL_ROWS", 6), ("written", spied)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(4)
    base = [f"v{i}" for i in range(60)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.sample(range(60), 1 + i % 4):
            words[at] = f"w{i}x{at}"
        rows.append((i, " ".join(words)))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute_components(rows) and len({c for _, c in found.values()}) > 3
    most = max(n for name, n in made if name == "crowded")
    assert [name for name, _ in made].count("met") == 1 and all(n <= 3 * most for _, n in made)


def steps_of_the_join(spark, monkeypatch):
    """What the join of crowded rows writes: name, columns, plan, and which tables of points are there at that time."""
    steps, points = [], []

    def there(df):
        path = spark._jvm.org.apache.hadoop.fs.Path(points[df][0])
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    def spied(df, name="step", write=jaccard_join.written):
        plan = df._jdf.queryExecution().executedPlan().toString()
        steps.append((name, df.columns, plan, [n for n in range(len(points)) if there(n)]))
        out = write(df, name)
        if name == "points":
            points.append(out.inputFiles())
        return out

    for name, value in (("REGION", 2), ("PICKS", 3), ("REPEATS", 2), ("PIVOTS", 2), ("written", spied)):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = crowded(1, 60)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute_components(rows)
    return steps


def test_the_join_moves_and_keeps_little(spark, monkeypatch):
    """Regions meet their sizes by number only, and anchors go as soon as they have met."""
    steps = steps_of_the_join(spark, monkeypatch)
    assert [columns for name, columns, _, _ in steps if name == "regions"] == [["region", "p", "size"]] * 2
    late, verified = [next(n for n, s in enumerate(steps) if s[0] == name) for name in ("late", "star")]
    assert steps[late][3] == [] and steps[verified][3] == []


def test_a_task_of_the_join_runs_one_python_function(spark, monkeypatch):
    for name, _, plan, _ in steps_of_the_join(spark, monkeypatch):
        kinds = re.findall(r"MapInPandas|MapInArrow|Exchange (?:hash|range|Round)", plan)
        assert not any(a.startswith("Map") and b.startswith("Map") for a, b in zip(kinds, kinds[1:])), name


def test_the_stage_keeps_one_of_each_group(spark, small):
    """The pipeline's stage, by five words and 80 %, against brute force: no near copy is missed, nothing else goes."""
    docs = table(spark, small, "documents")
    expected = brute_components([(r.doc_id, r.text) for r in docs.collect()], 80, 5)
    kept = {r.doc_id for r in corpus_pipeline.keep_one_of_each(spark, docs, small).collect()}
    assert kept == {i for i, (_, component) in expected.items() if i == component}
    assert len(kept) < docs.count()


def test_rows_of_one_id_are_one_node(spark):
    one, two = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(7, one), (7, two), (7, one), (3, one), (9, two + " more"), (5, "alone"), (2, " ".join(f"c{i}" for i in range(9)))]
    found = sorted((r.doc_id, r.component_id) for r in jaccard_join.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert found == [(2, 2), (3, 3), (5, 5), (7, 3), (7, 3), (7, 3), (9, 3)]


def test_join_of_odd_rows(spark, docs, no_docs):
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.joined(docs).collect()), key=str)
    assert len(found) == docs.count()
    assert (1, 9, 1) in found and (2, 9, 1) in found and (3, 0, 3) in found and (4, 0, 4) in found and (5, 0, 5) in found
    assert found.count((6, 1, 6)) == 2 and any(r[0] is None and r[2] is None for r in found)
    assert jaccard_join.joined(no_docs).count() == 0
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 2").count() == 0 and kept.count() == docs.count() - 1


def test_join_on_the_small_table(spark, small):
    rows = [(r.doc_id, r.text) for r in table(spark, small, "documents").collect()]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op3_jaccard_join(spark, small).collect()}
    assert found == brute_components(rows)


@pytest.mark.parametrize("few", [50_000, 0])
def test_components_of_a_chain_and_a_star(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW_EDGES", few)
    links = [(i, i + 1) for i in range(1, 30)] + [(100, i) for i in range(101, 120)]
    found = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {i: 1 for i in range(1, 31)} | {i: 100 for i in range(100, 120)}
    odd = spark.createDataFrame([(1, 1), (None, 2), (3, None), (5, 4), (4, 5)], "a long, b long")
    assert sorted(map(tuple, components.components(odd).collect())) == [(4, 4), (5, 4)]
    assert components.components(odd.limit(0)).collect() == []


def test_tiles_are_common_runs_and_find_moved_sentences():
    rng = random.Random(2)
    item = list(range(1, 41))
    text = [99] * 10 + item[20:40] + [98] * 7 + item[:20]
    assert sorted(decontaminate.tiles(text, item, 5)) == [(10, 20, 20), (37, 0, 20)]
    for _ in range(60):
        a = [rng.randrange(4) for _ in range(40)]
        b = [rng.randrange(4) for _ in range(25)]
        used_a, used_b = set(), set()
        for t, i, n in decontaminate.tiles(a, b, 3):
            assert n >= 3 and a[t : t + n] == b[i : i + n]
            assert not used_a & set(range(t, t + n)) and not used_b & set(range(i, i + n))
            used_a |= set(range(t, t + n))
            used_b |= set(range(i, i + n))
        free = lambda used, at: not used & set(range(at, at + 3))
        for t in range(38):
            for i in range(23):  # nothing that is long enough is left
                assert not (a[t : t + 3] == b[i : i + 3] and free(used_a, t) and free(used_b, i))


def test_leaks(spark, docs, no_docs):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    words = item.split()
    more = [(50, f"x y {item.upper()} z"), (51, " ".join(words[5:] + ["and"] + words[:5])), (52, " ".join(words[:4]) + " other")]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "too short"), (4, "")], "item_id long, text string")
    found = decontaminate.contaminated(both, bench)
    assert sorted((r.doc_id, r.item_id, r.n_tiles) for r in found.collect()) == [(50, 1, 1)] * 2 + [(51, 1, 2)] * 2
    blocks = decontaminate.contaminated(both, bench, block_chars=20)
    assert sorted(map(tuple, blocks.collect())) == sorted(map(tuple, found.collect()))
    assert sorted(r.doc_id for r in decontaminate.clean(both, bench).where("doc_id >= 50").collect()) == [52]
    assert decontaminate.contaminated(no_docs, bench).count() == 0
    assert decontaminate.contaminated(both, bench.limit(0)).count() == 0
    assert decontaminate.clean(docs, bench).columns == docs.columns


def by_place(rows, seed, epoch):
    """Rows of a leaf in the order of an epoch."""
    import hashlib

    return sorted(rows, key=lambda r: int(hashlib.md5(f"{seed}-{epoch}-{r[0]}".encode()).hexdigest()[:15], 16))


def fill(budget, nodes):
    """Brute force: deals the budget by weight, again and again, to children that are not full."""
    got = dict.fromkeys(nodes, 0.0)
    open_ = {n for n, (w, c) in nodes.items() if w > 0 and c > 0}
    while budget > 1e-9 and open_:
        share = budget / sum(nodes[n][0] for n in open_)
        budget = 0.0
        for n in list(open_):
            got[n] += share * nodes[n][0]
            if got[n] >= nodes[n][1] - 1e-12:
                budget += got[n] - nodes[n][1]
                got[n] = nodes[n][1]
                open_.discard(n)
    return got


STATED = (queries.MIX_DOMAINS, queries.MIX_LANGS)


@pytest.mark.parametrize("fraction,max_epochs,stated", [(0.5, 1, None), (1.0, 1, None), (0.9, 2, STATED), (0.4, 1, ({"src": 5.0}, {"en": 0.25, "no": 9.0}))])
def test_mix_equals_brute_force(spark, small, fraction, max_epochs, stated, monkeypatch):
    monkeypatch.setattr(mixing, "SMALL_CELL", 3)
    docs = table(spark, small, "documents")
    rows = mixing.measured(docs).collect()
    found = defaultdict(set)
    for r in mixing.mix(docs, fraction=fraction, max_epochs=max_epochs, seed=7, stated=stated).collect():
        found[r.epoch].add(r.doc_id)

    def weight(path):
        return stated[len(path) - 1].get(path[-1], 1.0) if stated and len(path) < 3 else 1.0

    leaves = defaultdict(list)
    for r in rows:
        leaves[r.leaf_domain, r.leaf_lang, r.leaf_source].append((r.id_, r.n_tokens))
    size = {k: sum(n for _, n in v) for k, v in leaves.items()}
    total = sum(size.values())
    capacity = lambda path: sum(n * max_epochs for k, n in size.items() if k[: len(path)] == path)
    budget = {(): min(total * fraction, total * max_epochs)}
    for depth in range(3):
        for path in [p for p in budget if len(p) == depth]:
            children = {k[: depth + 1] for k in leaves if k[:depth] == path}
            budget |= fill(budget[path], {c: (weight(c), capacity(c)) for c in children})
    expected = defaultdict(set)
    for leaf, members in leaves.items():
        full = min(int(budget[leaf] / size[leaf] + 1e-9), max_epochs) if size[leaf] else 1
        for e in range(1, full + 1):
            expected[e] |= {i for i, _ in members}
        rest, seen = budget[leaf] - full * size[leaf], 0
        for i, n in by_place(members, 7, full + 1):
            if seen < rest - 1e-6:
                expected[full + 1].add(i)
            seen += n
    assert {e: v for e, v in found.items() if v} == {e: v for e, v in expected.items() if v}


def test_mix_of_odd_rows_and_weights(spark, docs, no_docs):
    mixed = mixing.mix(docs, fraction=1.0)
    assert mixed.count() >= docs.where("text is not null").count() - 3
    assert mixed.columns == [c for c in docs.columns if c != "epoch"] + ["epoch"]
    weights = spark.createDataFrame([(["src"], 1.0), (["src", "en"], 1.0), (["src", "en", "src1"], 1.0)], "path array<string>, weight double")
    others = mixing.mix(docs, fraction=0.01, weights=weights).where("lang <> 'en'")
    assert {r.doc_id for r in others.collect()} == {4, 5}  # their leaf has no tokens, so it costs nothing
    assert mixing.mix(no_docs).count() == 0 and mixing.mix(no_docs, stated=STATED).count() == 0
    assert mixing.mix(docs, fraction=1.0, stated=({"nowhere": 2.0}, {})).count() >= docs.where("text is not null").count() - 3


def test_leaves_are_filled_to_their_budgets(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = mixing.measured(docs)
    plan = mixing.leaf_plan(rows, 0.5, mixing.weight_table(rows, *STATED), 1, 7)
    for r in mixing.filled(rows, plan, 7).collect():
        assert r.budget - 1e-6 <= r.taken <= r.tokens or r.taken - r.budget < 30_000
        assert r.taken >= min(r.budget, r.tokens) - 1e-6


def test_shards_fit_their_limit(spark, docs, no_docs):
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab"), (F.col("id") % 50).cast("int")).alias("text"))
    found = sharding.assign(many, limit=2000).toPandas()
    assert len(found) == 3000
    sizes = found.groupby(["shard_id", "page"])["n_bytes"].sum()
    assert sizes.max() <= 2000 and found["page"].max() == 0
    assert found.groupby("shard_id")[["depth", "prefix"]].nunique().max().max() == 1
    # a bucket was split only because its parent was too large
    whole = found.assign(parent=found["prefix"] // 2, up=found["depth"] - 1)
    for (up, parent), _ in whole.groupby(["up", "parent"]):
        inside = found[(found["prefix"] // 2 ** (found["depth"] - up).clip(lower=0) == parent) & (found["depth"] > up)]
        assert up < 0 or inside["n_bytes"].sum() > 2000
    same = spark.range(900).select(F.lit(5).alias("doc_id"), F.when(F.col("id") == 0, F.repeat(F.lit("x"), 5000)).otherwise("abcdefghij").alias("text"))
    pages = sharding.assign(same, limit=1000).toPandas().groupby(["shard_id", "page"])["n_bytes"].agg(["sum", "count"])
    assert len(pages[pages["sum"] > 1000]) == 1 and pages["sum"].max() == 5000 and pages["count"].sum() == 900
    assert sharding.assign(docs).count() == docs.count() and sharding.assign(no_docs).count() == 0


def test_written_shards(spark, docs, tmp_path):
    sharding.write_shards(docs.select("doc_id", "text"), str(tmp_path / "s"), limit=100)
    assert spark.read.parquet(str(tmp_path / "s")).count() == docs.count()


def reference_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.word_bpe())
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def test_token_shards_round_trip(spark, docs, no_docs, small):
    tokenizer = queries.word_bpe()
    rows = [(r.doc_id, r.text) for r in table(spark, small, "documents").orderBy("doc_id").collect()]
    start = 0
    found = {r.doc_id: r for r in token_output.encoded(table(spark, small, "documents"), tokenizer, shard_tokens=20_000).collect()}
    for (doc_id, _), ids in zip(rows, reference_ids([t for _, t in rows]), strict=True):
        row = found[doc_id]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), crc)
        start += len(ids)
    odd = token_output.encoded(docs, tokenizer).collect()
    assert len(odd) == docs.count() and sum(r.n_tokens == 1 for r in odd) == 3
    assert min(odd, key=lambda r: r.start).doc_id is None
    assert token_output.encoded(no_docs, tokenizer).count() == 0


@pytest.mark.parametrize("runs, piece", [(2_000_000, 1 << 20), (10, 300)])
def test_encoder_equals_tokenizer(monkeypatch, runs, piece):
    monkeypatch.setattr(token_output, "CACHE_RUNS", runs)
    monkeypatch.setattr(token_output, "PIECE", piece)
    encoder = token_output.Encoder(queries.word_bpe())
    rng = random.Random(4)
    texts = ["it's Don't we'LL", "<|endoftext|> a", None, "", "  ", "a1b22 c³½", "ΣΑΣ İstanbul", "éa", "日本語", "\x1c\x85a b", "--a..b!!c"]
    texts += ["".join(rng.choice("aB9 .'éß$\n€ͅ") for _ in range(50)) for _ in range(200)]
    assert [[*x, 2] for x in encoder.encode(texts)] == reference_ids(texts)


def peak_of(work):
    tracemalloc.start()
    work()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak


def test_encoder_and_compression_need_little_memory():
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.choice('abcdef')}{rng.choice('ghijkl')}" for _ in range(500)) for _ in range(1000)]
    assert peak_of(lambda: token_output.Encoder(queries.word_bpe()).encode(texts)) < 45  # MB; 18, and 73 before
    ids = (np.random.default_rng(7).zipf(1.3, 1_000_000) % 3000).astype(np.uint16)
    last = np.arange(1, len(ids) + 1) % 500 == 0
    assert peak_of(lambda: token_output.compress(ids, last)) < 44  # MB; 37, and 50 before


def test_long_texts_are_encoded_in_pieces(monkeypatch):
    monkeypatch.setattr(token_output, "PIECE", 300)
    encoder, seen, whole = token_output.Encoder(queries.word_bpe()), [], token_output.Encoder.whole
    monkeypatch.setattr(token_output.Encoder, "whole", lambda self, texts: seen.extend(map(len, texts)) or whole(self, texts))
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab 1.\n") for _ in range(5000)), "x" * 1000 + " " + "y" * 900, "z" * 2000, " " * 900]
    assert [[*x, 2] for x in encoder.encode(texts)] == reference_ids(texts)
    assert max(seen) == 2000  # a run alone; the text of 5000 characters never


def test_runs_are_remembered_and_forgotten(monkeypatch):
    token_output.worker_encoder.cache_clear()
    encoder = token_output.worker_encoder(queries.word_bpe())
    assert token_output.worker_encoder(queries.word_bpe()) is encoder
    encoder.encode(["one two three"])
    assert encoder.size.n == 3
    monkeypatch.setattr(token_output, "CACHE_RUNS", 1)
    monkeypatch.setattr(token_output, "RUN_IDS", 1)
    encoder.encode(["four"])
    assert encoder.size.n == 1
    token_output.worker_encoder.cache_clear()


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(6)
    ids = [rng.integers(0, 12, size=n).astype(np.uint16) for n in (1, 500, 3, 4000, 1)]
    row = dict(zip([c.split()[0] for c in token_output.SHARD.split(", ")], token_output.pack(0, 0, [4, None, 5, 6, 7], ids), strict=True))
    shard = type("Shard", (), row | {"shard_start": 0})
    assert len(row["stream"]) < 0.6 * 2 * sum(map(len, ids)) and len(row["rules"]) > 0
    for place, expected in enumerate(ids):
        assert np.array_equal(token_output.decode_document(shard, place), expected)
    lengths = np.frombuffer(row["rule_tokens"], "<u4")
    grammar = token_output.Grammar(np.frombuffer(row["rules"], "<u2").reshape(-1, 2), lengths)
    assert [len(grammar.expand(np.array([token_output.FIRST + k]))) for k in range(len(lengths))] == lengths.tolist()


def test_rules_expand_in_a_few_rounds():
    rng = np.random.default_rng(9)
    rules = np.array([[rng.integers(0, 50), token_output.FIRST + k - 1 - k % 5] if k > 5 else [k, k + 1] for k in range(60)], dtype="<u2")
    plain = {}
    for k, (a, b) in enumerate(rules.tolist()):
        plain[token_output.FIRST + k] = [*plain.get(a, [a]), *plain.get(b, [b])]
    lengths = token_output.rule_lengths(rules)
    assert lengths.tolist() == [len(x) for x in plain.values()]
    grammar = token_output.Grammar(rules, lengths)
    assert [grammar.expand(np.array([s])).tolist() for s in plain] == list(plain.values())
    assert 2 < len(list(token_output.rounds(rules))) < len(rules)


def test_re_pair_goes_on_while_pairs_are_frequent():
    ids = np.tile(np.arange(100, 1100, dtype=np.uint32), 200)
    last = np.zeros(len(ids), dtype=bool)
    last[999::1000] = True
    rules, stream, _ = token_output.compress(ids.copy(), last)
    assert len(stream) == 200  # a symbol for each of the 200 copies
    grammar = token_output.Grammar(rules, token_output.rule_lengths(rules))
    assert grammar.expand(stream).tolist() == ids.tolist()


def test_pipeline_stages(spark, small):
    docs = table(spark, small, "documents")
    columns, held = docs.columns, docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, held, small)
        assert out.columns == columns
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in held.select("doc_id").collect()} and ids
        held = spark.createDataFrame(out.collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, held, small)
    assert sorted(r.doc_id for r in last.collect()) == sorted(ids)


def test_pipeline_drops_near_copies_between_the_thresholds(spark, small):
    words = [f"w{i}" for i in range(50)]
    other = words[:25] + ["changed"] + words[26:]
    rows = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other))], "doc_id long, text string")
    assert jaccard_join.one_of_each(rows).count() == 2  # 43 of 51 shingles of four words
    assert [r.doc_id for r in corpus_pipeline.keep_one_of_each(spark, rows, small).collect()] == [1]  # 41 of 51 of five


def test_pipeline_of_odd_and_no_rows(spark, docs, no_docs, small):
    for rows in (docs.select("doc_id", "text", "lang", "source", "n_chars"), no_docs.select("doc_id", "text", "lang", "source", "n_chars")):
        held = rows
        for _, stage in corpus_pipeline.STAGES:
            held = stage(spark, held, small)
        assert (held.count() > 0) == (rows is not no_docs and rows.count() > 0)
