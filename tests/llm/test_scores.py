"""Toxicity and quality classifiers: held-out accuracy on the given tables, odd rows, empty tables."""

import random

import numpy as np
import pytest

from gridtide.llm import fitting, quality_crf, queries, toxicity
from gridtide.llm.common import table


def held_out_accuracy(spark, small, query, label):
    found = query(spark, small).toPandas()
    assert len(found) == table(spark, small, "documents").count()
    assert found["score"].between(0, 1).all()
    labels = table(spark, small, "labels").toPandas()
    held = found.merge(labels, on="doc_id")
    held = held[held["held_out"]]
    return (held["predicted"] == held[label]).mean()


def test_toxicity_on_held_out_rows(spark, small):
    assert held_out_accuracy(spark, "/root/testdata/sf0.01", queries.op1_toxicity, "toxic") >= 0.93


def test_quality_on_held_out_rows(spark, small):
    assert held_out_accuracy(spark, "/root/testdata/sf0.01", queries.op2_quality_crf, "quality") >= 0.93


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality_crf, "quality")])
def test_odd_rows_and_empty_tables(spark, docs, no_docs, module, label):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 0), (4, None), (99, 1), (6, 0)], f"doc_id long, {label} int")
    found = module.scored(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    by_id = {}
    for r in found:
        assert by_id.setdefault(r.doc_id, r.score) == r.score or r.doc_id == 6
    assert by_id[1] == by_id[2] and by_id[4] == by_id[5] == by_id[3]
    assert module.scored(no_docs, labels).count() == 0
    assert module.scored(docs, labels.limit(0)).count() == docs.count()


def test_accepted_keeps_rows_without_an_id(spark, docs):
    texts = [(i, "you idiot trash" if i % 3 == 0 else "a calm and friendly text", "en", "s") for i in range(90)]
    many = spark.createDataFrame([*texts, (None, "you idiot trash", "en", "s")], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    kept = toxicity.accepted(many, labels)
    assert kept.columns == many.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [i for i in range(90) if i % 3]
    assert kept.where("doc_id is null").count() == 1


def test_label_model_finds_good_voters_and_splits_twins():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.2
    speak = lambda hit, false: np.where(truth, rng.random(4000) < hit, rng.random(4000) < false)
    good, bad = speak(0.8, 0.02), speak(0.3, 0.25)
    votes = np.column_stack([good, speak(0.7, 0.03), speak(0.75, 0.02), bad, bad, speak(0.9, 0.05)]).astype(float)
    model = toxicity.fit_label_model(votes, np.ones_like(votes), np.ones(4000), 0.2)
    assert abs(model.fires[1, 0] - 0.8) < 0.08 and abs(model.prior - 0.2) < 0.05
    assert model.share[3] < 0.6 < model.share[1]
    assert ((model.posterior(votes, np.ones_like(votes)) > 0.5) == truth).mean() > 0.97


def test_forward_backward_equals_enumeration():
    random.seed(5)
    lines = quality_crf.Lines(["a b\nc d e\nf", "", "one line", "x\ny"])
    node = np.random.default_rng(1).normal(size=len(lines.x))
    edge = np.array([[0.3, -0.2], [0.1, 0.8]])
    bad, pairs = quality_crf.forward_backward(lines, node, edge)
    total = np.zeros((2, 2))
    for start, n in zip(lines.start, lines.n, strict=True):
        states = [[s >> t & 1 for t in range(n)] for s in range(2**n)] if n else []
        weight = np.array([np.exp(sum(node[start + t] * s[t] for t in range(n)) + sum(edge[s[t - 1], s[t]] for t in range(1, n))) for s in states])
        for t in range(n):
            expected = sum(w for w, s in zip(weight, states, strict=True) if s[t]) / weight.sum()
            assert abs(bad[start + t] - expected) < 1e-9
            if t:
                for w, s in zip(weight, states, strict=True):
                    total[s[t - 1], s[t]] += w / weight.sum()
    assert np.allclose(pairs, total)


def test_logistic_separates():
    rows, columns = np.arange(40), np.array([0, 1] * 20)
    weights = fitting.logistic(rows, columns, np.ones(40), np.array([0.0, 1.0] * 20), 2)
    assert weights[0] + weights[-1] < 0 < weights[1] + weights[-1]
