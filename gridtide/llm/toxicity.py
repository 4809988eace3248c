"""Toxicity by weak supervision.

Cues are words and word beginnings that labelled toxic texts hold far more often than others. They are dealt into
lexicons; each lexicon votes when a text holds one of its cues, and pattern voters look at density, repetition, shouting
and exclamations. A generative label model over the votes of all documents estimates, by expectation maximisation, how
often each voter speaks in toxic and in other texts; voters that err together, by their correlation within the classes,
share their weight. Annotators are one more voter, where they spoke outside the held-out fold. The posterior labels of a
bounded sample of all documents outside that fold, most of them without a label, then train a linear classifier on the
cues, which scores every text.

Defined results: a null or empty text has no cue and scores the classifier's intercept; equal texts score equally; rows
with one id are scored one by one; without labels of both kinds the score is the smoothed share of toxic labels; an
empty table gives an empty result; columns other than id and text are never looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import forget, is_held_out, without, written
from .fitting import FIT_ROWS, fit_sample, logistic, sigmoid

LETTERS = re.compile(r"[^\W\d_]+")
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
PREFIXES = range(3, 9)
MIN_POSITIVE = 4
MAX_CANDIDATES = 50_000
MAX_CUES = 2000
LEAST_Z = 2.5
N_LEXICONS = 10
#: Distinct features that a task counts before it hands their counts on.
FEATURES_HELD = 50_000
#: Words whose cues a task remembers; then it forgets them all.
CACHED_WORDS = 100_000
PATTERNS = ("dense", "repeated", "shouting", "exclaiming")
N_VOTERS = N_LEXICONS + len(PATTERNS)


def features_of(word: str) -> Iterator[str]:
    """The word itself ("=word") and its beginnings ("^wor")."""
    yield "=" + word
    for n in PREFIXES:
        if len(word) > n:
            yield "^" + word[:n]


def counted(text: str) -> Counter:
    return Counter(LETTERS.findall(text.lower()))


def find_cues(sample: DataFrame) -> list[tuple[str, bool]]:
    """Features associated with label 1, by z score, strongest first, at most ``MAX_CUES``; with each, whether most
    of the sampled texts that hold it are toxic. Only such features stand in lexicons.

    Candidates come from toxic texts, and only candidates are counted in the others.
    """

    def in_positive(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = Counter()
        for batch in batches:
            for text in batch["text"]:
                held.update({f for w in counted(text) for f in features_of(w)})
                if len(held) >= FEATURES_HELD:
                    yield pd.DataFrame({"feature": list(held), "n": list(held.values())})
                    held = Counter()
        if held:
            yield pd.DataFrame({"feature": list(held), "n": list(held.values())})

    positive = sample.where("y = 1")
    candidates = (
        positive.select("text").mapInPandas(in_positive, "feature string, n long").groupBy("feature")
        .agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_POSITIVE).orderBy(F.desc("n"), "feature")
        .limit(MAX_CANDIDATES).collect()
    )
    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_positive, n_negative = totals.get(1, 0), totals.get(0, 0)
    if not candidates or not n_negative:
        return []
    names = frozenset(r["feature"] for r in candidates)

    def in_negative(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = Counter()
            for text in batch["text"]:
                held.update(names.intersection(f for w in counted(text) for f in features_of(w)))
            if held:
                yield pd.DataFrame({"feature": list(held), "n": list(held.values())})

    negative = {
        r["feature"]: r["n"]
        for r in sample.where("y = 0").select("text").mapInPandas(in_negative, "feature string, n long")
        .groupBy("feature").agg(F.sum("n").alias("n")).collect()
    }
    scored = []
    for r in candidates:
        p, q = r["n"] + 0.5, negative.get(r["feature"], 0) + 0.5
        odds = math.log(p / (n_positive + 1 - p)) - math.log(q / (n_negative + 1 - q))
        z = odds / math.sqrt(1 / p + 1 / q)
        if z > LEAST_Z:
            scored.append((-z, r["feature"], p > q))
    return [(name, precise) for _, name, precise in sorted(scored)[:MAX_CUES]]


class Voters:
    """Finds the cues of a text and casts the votes, as bits: lexicons first, then the patterns."""

    def __init__(self, cues: Sequence[tuple[str, bool]]):
        self.index = {name: i for i, (name, _) in enumerate(cues)}
        precise = [i for i, (_, p) in enumerate(cues) if p]
        self.lexicon = {cue: rank % N_LEXICONS for rank, cue in enumerate(precise)}
        self.of_word: dict[str, tuple[int, ...]] = {}

    def cues_of(self, word: str) -> tuple[int, ...]:
        found = self.of_word.get(word)
        if found is None:
            found = tuple(i for f in features_of(word) if (i := self.index.get(f)) is not None)
            if len(self.of_word) >= CACHED_WORDS:
                self.of_word.clear()
            self.of_word[word] = found
        return found

    def look(self, text: str) -> tuple[list[int], list[int], int, int]:
        """Cue ids, their counts, the number of words, the votes."""
        held: Counter = Counter()
        n_words = 0
        for word, n in counted(text).items():
            n_words += n
            for cue in self.cues_of(word):
                held[cue] += n
        votes, strong = 0, []
        for cue, n in held.items():
            lexicon = self.lexicon.get(cue)
            if lexicon is not None:
                votes |= 1 << lexicon
                strong.append(n)
        total = sum(strong)
        capitals = len(UPPER.findall(text))
        patterns = (
            total * 10 > n_words > 0,
            any(n > 2 for n in strong),
            capitals * 10 > 3 * (sum(map(len, LETTERS.findall(text))) if capitals > 20 else 1 << 60),
            text.count("!") * 20 > n_words > 0,
        )
        for k, fires in enumerate(patterns):
            votes |= fires << (N_LEXICONS + k)
        return list(held.keys()), list(held.values()), n_words, votes


def look_all(docs: DataFrame, cues: Sequence[tuple[str, bool]], doc: str, text: str) -> DataFrame:
    """Narrow rows of all documents: cues, counts, votes."""
    schema = "doc_id long, cue array<int>, n array<int>, n_words int, votes int"
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def look(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        voters = Voters(cues)
        for batch in batches:
            found = [voters.look(t or "") for t in batch["text"]]
            out = pd.DataFrame(found, columns=["cue", "n", "n_words", "votes"])
            out.insert(0, "doc_id", batch["doc_id"].values)
            yield out

    return rows.mapInPandas(look, schema)


@dataclass
class LabelModel:
    """``fires[c, v]``: how often voter v speaks in class c; ``share[v]``: its weight among voters that err with it."""

    prior: float
    fires: np.ndarray
    share: np.ndarray

    def posterior(self, votes: np.ndarray, spoke: np.ndarray) -> np.ndarray:
        """P(toxic) of rows of votes (0/1); ``spoke`` is 0 where a voter had no say."""
        odds = np.log(self.fires[1] / self.fires[0]), np.log((1 - self.fires[1]) / (1 - self.fires[0]))
        total = (self.share * spoke * (votes * odds[0] + (1 - votes) * odds[1])).sum(axis=1)
        return sigmoid(math.log(self.prior / (1 - self.prior)) + total)


def fit_label_model(votes: np.ndarray, spoke: np.ndarray, n: np.ndarray, prior: float, rounds: int = 40) -> LabelModel:
    """Expectation maximisation on the distinct vote rows, ``n`` times each. The last voter is the annotator.

    After each maximisation the correlations of voters within the classes are measured on the posterior; a voter's
    share is one over one plus its positive correlations, so a clique of equal voters counts about once.
    """
    k = votes.shape[1]
    fires = np.stack([np.full(k, 0.02), np.full(k, 0.3)])
    fires[:, -1] = 0.03, 0.9
    model = LabelModel(prior, fires, np.ones(k))
    for _ in range(rounds):
        p = model.posterior(votes, spoke)
        for c, weight in enumerate((n * (1 - p), n * p)):
            said = (weight[:, None] * spoke).sum(axis=0)
            model.fires[c] = ((weight[:, None] * spoke * votes).sum(axis=0) + 0.5) / (said + 1.0)
        model.prior = float(np.clip((n * p).sum() / n.sum(), 1e-4, 0.5))
        residual = spoke * (votes - (1 - p)[:, None] * model.fires[0] - p[:, None] * model.fires[1])
        cov = (residual * n[:, None]).T @ residual
        scale = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        corr = np.clip(cov / scale[:, None] / scale[None, :], 0.0, 1.0)
        np.fill_diagonal(corr, 0.0)
        model.share = 1.0 / (1.0 + corr.sum(axis=1))
        model.fires[1] = np.maximum(model.fires[1], model.fires[0] * 1.01)  # no voter speaks for the other class
        model.fires = np.clip(model.fires, 1e-5, 1 - 1e-5)
    return model


def spread(votes: np.ndarray, said: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vote bits and the annotator's word (-1: none) as two matrices."""
    bits = (votes[:, None] >> np.arange(N_VOTERS)) & 1
    return (
        np.column_stack([bits, np.maximum(said, 0)]).astype(float),
        np.column_stack([np.ones_like(bits), said >= 0]).astype(float),
    )


def sparse(cues: Sequence, counts: Sequence, n_words: Sequence, n_cues: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two columns a cue: logarithm of its count, and its count per ten words."""
    sizes = np.array([len(c) for c in cues], dtype=np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    if not len(rows):
        return rows, rows, rows.astype(float)
    column, count = np.concatenate(cues).astype(np.int64), np.concatenate(counts).astype(float)
    density = 10.0 * count / (np.repeat(np.asarray(n_words, dtype=float), sizes) + 20.0)
    return np.concatenate([rows, rows]), np.concatenate([column, column + n_cues]), np.concatenate([np.log1p(count), density])


def fit_rows_of(seen: DataFrame, fit_rows: int) -> DataFrame:
    """At most ``fit_rows`` looked-at rows, one an id, of all documents outside the held-out fold, in hash order."""
    ids = seen.where(F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id_")).distinct()
    ids = written(ids.orderBy(F.xxhash64("id_"), "id_").limit(fit_rows), "fit-ids")
    one = seen.join(F.broadcast(ids), F.col("doc_id") == F.col("id_")).groupBy("doc_id")
    return one.agg(F.min(F.struct("votes", "cue", "n", "n_words")).alias("row")).select("doc_id", "row.*")


def scored(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", doc: str = "doc_id", text: str = "text",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 from 0.5 on), and the label model's ``posterior``."""
    sample = written(fit_sample(docs, labels, label, fit_rows, doc, text), "fit-sample")
    cues = find_cues(sample)
    seen = written(look_all(docs, cues, doc, text), "votes")
    said = (
        labels.where(F.col(label).isNotNull() & ~is_held_out(F.col(doc)))
        .groupBy(F.col(doc).cast("long").alias("said_id")).agg(F.max(F.col(label)).cast("int").alias("said"))
    )
    # at most 2^14 vote rows times three words of the annotator, however many documents
    patterns = (
        seen.select("doc_id", "votes").join(said, F.col("doc_id") == F.col("said_id"), "left")
        .groupBy("votes", F.coalesce("said", F.lit(-1)).alias("said")).agg(F.count("*").alias("n")).toPandas()
    )
    positive = sample.agg(F.coalesce(F.sum("y"), F.lit(0)), F.count("*")).first()
    share = (positive[0] + 1.0) / (positive[1] + 20.0)
    if cues and len(patterns):
        votes, spoke = spread(patterns["votes"].to_numpy(), patterns["said"].to_numpy())
        model = fit_label_model(votes, spoke, patterns["n"].to_numpy(dtype=float), share)
        fit = fit_rows_of(seen, fit_rows).join(said, F.col("doc_id") == F.col("said_id"), "left")
        fit = fit.withColumn("said", F.coalesce("said", F.lit(-1))).toPandas().sort_values("doc_id", ignore_index=True)
        x = sparse(fit["cue"].tolist(), fit["n"].tolist(), fit["n_words"].tolist(), len(cues))
        # labelled or not, a row's target is what its voters say; the annotator is one of them where there is one
        targets = model.posterior(*spread(fit["votes"].to_numpy(), fit["said"].to_numpy()))
        weights = logistic(*x, targets, 2 * len(cues))
    else:
        model, weights = None, np.array([math.log(share / (1 - share))])
    n_cues = len(cues)
    forget(sample)

    def score(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, columns, values = sparse(batch["cue"].tolist(), batch["n"].tolist(), batch["n_words"].tolist(), n_cues)
            total = np.bincount(rows, values * weights[columns], minlength=len(batch)) + weights[-1]
            votes = spread(batch["votes"].to_numpy(), np.full(len(batch), -1))
            posterior = model.posterior(*votes) if model else np.full(len(batch), share)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": sigmoid(total), "posterior": posterior})

    out = seen.mapInPandas(score, "doc_id long, score double, posterior double")
    return out.select(
        "doc_id",
        F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "posterior",
    )


def accepted(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", **options) -> DataFrame:
    """``docs`` without those predicted toxic; rows with one id share its fate, rows without an id stay."""
    judged = scored(docs, labels, doc=doc, **options)
    kept = without(docs, judged.where("predicted = 1").select("doc_id"), doc)
    forget(judged)
    return kept
