"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad. The features of a line are its own counts and those of the lines before
and after it; transitions let bad lines keep together. Labels exist for documents only, so the lines of good documents
start as good and those of bad ones as bad, and after each fit the lines of bad documents are labelled again by their
marginals (the worst line of a bad document stays bad). Forward-backward gives each line its probability of being bad;
weighted by line length they make the document's badness, and a logistic curve fitted on the same documents turns that
into the score.

Defined results: a text without a word has no lines and no badness, and scores by the curve like a clean one; equal
texts score equally; rows with one id are scored one by one; without labels of both kinds the score is the smoothed
share of label 1; an empty table gives an empty result; columns other than id and text are never looked at. Long texts
are read whole, line by line; the fit uses a bounded sample of labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from .common import forget, is_held_out, written
from .fitting import Adam, fit_sample, logistic, sigmoid

#: Bounds of the fitting sample: documents, and the lines and characters of all of them together.
FIT_ROWS, FIT_LINES, FIT_CHARS = 4000, 400_000, 40_000_000
#: Longer documents are fitted as several chains of so many lines, so that a step over all chains stays long and steps few.
CHAIN = 256
SYMBOLS = re.compile(r"[#*$%&|<>{}\[\]\\^~_=+]")
DIGITS = re.compile(r"\d")
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
ENDS = frozenset(".!?:;…\"'”»)")
NAMES = (
    "log_words", "word_length", "distinct", "same_as_before", "most_common", "symbols", "pipes", "digits", "upper",
    "ends", "starts_upper", "exclaims", "seen_line", "short", "long_word",
)
N_OWN = len(NAMES)
N_FEATURES = 3 * N_OWN + 1


def line_features(text: str) -> tuple[list[tuple], list[int]]:
    """Own features of every line with a word, and the lengths of those lines."""
    rows, sizes, seen = [], [], set()
    for line in text.split("\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        chars = len(line)
        counts = Counter(words)
        again = sum(a == b for a, b in zip(words, words[1:], strict=False)) if len(counts) < n else 0
        rows.append(
            (
                math.log1p(n) / 4.0,
                min(chars / n, 40.0) / 10.0,
                len(counts) / n,
                again / n,
                max(counts.values()) / n if n > 4 else 0.0,
                min(len(SYMBOLS.findall(line)) / n, 3.0),
                min(line.count("|") / n, 1.0),
                len(DIGITS.findall(line)) / chars,
                len(UPPER.findall(line)) / chars,
                float(line.rstrip()[-1] in ENDS),
                float(words[0][0].isupper()),
                min(line.count("!") / n, 2.0),
                float(line in seen),
                float(n < 4),
                float(any(len(w) > 30 for w in counts)),
            )
        )
        seen.add(line)
        sizes.append(chars)
    return rows, sizes


class Lines:
    """The lines of many documents as one matrix, with the places of the documents, longest document first."""

    def __init__(self, texts: Sequence[str | None]):
        parts = [line_features(t or "") for t in texts]
        self.n = np.array([len(r) for r, _ in parts], dtype=np.int64)
        self.start = np.cumsum(self.n) - self.n
        own = np.array([row for rows, _ in parts for row in rows], dtype=float).reshape(-1, N_OWN)
        self.size = np.array([s for _, sizes in parts for s in sizes], dtype=float)
        first = np.zeros(len(own), dtype=bool)
        first[self.start[self.n > 0]] = True
        before, after = np.zeros_like(own), np.zeros_like(own)
        before[1:] = np.where(first[1:, None], 0.0, own[:-1])
        after[:-1] = np.where(first[1:, None], 0.0, own[1:])
        self.x = np.concatenate([own, before, after, np.ones((len(own), 1))], axis=1)
        self.doc = np.repeat(np.arange(len(texts)), self.n)
        self.order = np.argsort(-self.n, kind="stable")
        sorted_n = self.n[self.order]
        # places of the t-th lines of all documents that have one
        self.steps = []
        active = len(sorted_n)
        for t in range(int(sorted_n[0]) if len(sorted_n) else 0):
            while active and sorted_n[active - 1] <= t:
                active -= 1
            self.steps.append(self.start[self.order[:active]] + t)


def forward_backward(lines: Lines, node: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(bad) of every line, and the summed probabilities of neighbours (2 x 2). ``node`` are log odds of bad.

    Messages are kept as log odds of bad against good, so no sum overflows.
    """
    (a, b), (c, d) = edge  # edge[i][j]: from state i to state j; 0 good, 1 bad
    send = lambda m: np.logaddexp(b, d + m) - np.logaddexp(a, c + m)  # noqa: E731  to the next line
    back = lambda m: np.logaddexp(c, d + m) - np.logaddexp(a, b + m)  # noqa: E731  to the line before
    forward, backward = np.zeros(len(node)), np.zeros(len(node))
    for t in range(1, len(lines.steps)):
        at = lines.steps[t]
        forward[at] = send(node[at - 1] + forward[at - 1])
    for t in range(len(lines.steps) - 2, -1, -1):
        at = lines.steps[t + 1]
        backward[at - 1] = back(node[at] + backward[at])
    left = node + forward
    bad = sigmoid(left + backward)
    pairs = np.zeros((2, 2))
    if len(lines.steps) > 1:
        at = np.concatenate(lines.steps[1:])
        u, v = left[at - 1], node[at] + backward[at]
        logs = np.stack([np.full(len(at), a), b + v, c + u, d + u + v])
        logs -= logs.max(axis=0)
        p = np.exp(logs)
        pairs = (p / p.sum(axis=0)).sum(axis=1).reshape(2, 2)
    return bad, pairs


class Crf:
    """Weights of the line features and of the transitions."""

    def __init__(self):
        self.weights, self.edge = np.zeros(N_FEATURES), np.zeros((2, 2))

    def marginals(self, lines: Lines) -> np.ndarray:
        return forward_backward(lines, lines.x @ self.weights, self.edge)[0]

    def fit(self, lines: Lines, bad: np.ndarray, steps: int = 120, penalty: float = 1e-3) -> None:
        """Climbs the conditional likelihood of the line labels ``bad``."""
        adam = Adam(N_FEATURES + 4, 0.1)
        seen = np.zeros((2, 2))
        if len(lines.steps) > 1:
            at = np.concatenate(lines.steps[1:])
            np.add.at(seen, (bad[at - 1].astype(int), bad[at].astype(int)), 1.0)
        total = max(1, len(bad))
        for _ in range(steps):
            p, pairs = forward_backward(lines, lines.x @ self.weights, self.edge)
            gradient = np.concatenate([lines.x.T @ (p - bad), (pairs - seen).ravel()]) / total
            gradient += penalty * np.concatenate([self.weights, self.edge.ravel()])
            move = adam.step(gradient)
            self.weights = self.weights - move[:N_FEATURES]
            self.edge = self.edge - move[N_FEATURES:].reshape(2, 2)


def badness(of: np.ndarray, size: np.ndarray, bad: np.ndarray, n: int) -> np.ndarray:
    """Share of the characters of each of ``n`` documents that stand in bad lines, by expectation; 0 without lines.

    ``of`` says which document a line is from, ``size`` how long it is, ``bad`` how likely it is bad.
    """
    weight = np.bincount(of, size, minlength=n)
    return np.bincount(of, size * bad, minlength=n) / np.maximum(weight, 1.0)


def bounded(sample: DataFrame, fit_lines: int = FIT_LINES, fit_chars: int = FIT_CHARS) -> pd.DataFrame:
    """The sampled documents that the fit takes, whole: in hash order, each that still fits the budgets of lines and
    characters. If a label has none that fits, its shortest document is taken."""
    n_lines = F.size(F.split("text", "\n", -1))
    sizes = sample.select("doc_id", "y", n_lines.alias("lines"), F.length("text").alias("chars"), F.xxhash64("doc_id").alias("h")).toPandas()
    lines, chars, taken = fit_lines, fit_chars, []
    for r in sizes.sort_values(["h", "doc_id"]).itertuples():
        if r.lines <= lines and r.chars <= chars:
            lines, chars = lines - r.lines, chars - r.chars
            taken.append(r.doc_id)
    for label in (0, 1):
        of_label = sizes[sizes["y"] == label]
        if len(of_label) and not of_label["doc_id"].isin(taken).any():
            taken.append(of_label.sort_values(["chars", "doc_id"])["doc_id"].iloc[0])
    spark = sample.sparkSession
    key = T.StructType([T.StructField("taken_id", sample.schema["doc_id"].dataType)])
    ids = spark.createDataFrame([(i.item() if hasattr(i, "item") else i,) for i in taken], key)
    found = sample.join(F.broadcast(ids), F.col("doc_id") == F.col("taken_id")).drop("taken_id").toPandas()
    return found.sort_values(["doc_id", "text"], ignore_index=True)




def chains(texts: Sequence[str]) -> tuple[list[str], np.ndarray]:
    """The texts cut into chains of ``CHAIN`` lines, and the number of the text that each chain is from."""
    pieces, owner = [], []
    for i, text in enumerate(texts):
        lines = text.split("\n")
        for at in range(0, len(lines), CHAIN):
            pieces.append("\n".join(lines[at : at + CHAIN]))
            owner.append(i)
    return pieces, np.array(owner, dtype=np.int64)


def train(texts: Sequence[str], good: np.ndarray, rounds: int = 3) -> tuple[Crf, np.ndarray]:
    """The field, and the weights of the curve from badness to score."""
    pieces, owner = chains(texts)
    lines, crf = Lines(pieces), Crf()
    of = owner[lines.doc]
    bad_doc = (good == 0)[of]
    bad = bad_doc.astype(float)
    for _ in range(rounds):
        crf.fit(lines, bad)
        p = crf.marginals(lines)
        worst = np.zeros(len(texts))
        np.maximum.at(worst, of, p)
        bad = (bad_doc & ((p >= 0.5) | (p >= worst[of]))).astype(float)
    return crf, curve(badness(of, lines.size, crf.marginals(lines), len(texts)), good)


def curve(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    n = len(bad)
    return logistic(np.arange(n), np.zeros(n, dtype=np.int64), bad, good.astype(float), 1, 1e-5, 1500, 0.2)


def scored(
    docs: DataFrame, labels: DataFrame, label: str = "quality", doc: str = "doc_id", text: str = "text",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 from 0.3 on), badness, n_lines."""
    chosen = written(fit_sample(docs, labels, label, fit_rows, doc, text), "fit-sample")
    sample = bounded(chosen)
    forget(chosen)
    good = sample["y"].to_numpy(dtype=int) if len(sample) else np.zeros(0, dtype=int)
    if 0 < good.sum() < len(good):
        crf, weights = train(sample["text"].tolist(), good)
    else:
        share = (good.sum() + 1.0) / (len(good) + 2.0)
        crf, weights = Crf(), np.array([0.0, math.log(share / (1 - share))])
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def score(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = Lines(batch["text"].tolist())
            bad = badness(lines.doc, lines.size, crf.marginals(lines), len(lines.n))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "score": sigmoid(weights[0] * bad + weights[1]),
                    "badness": bad,
                    "n_lines": lines.n,
                }
            )

    out = rows.mapInPandas(score, "doc_id long, score double, badness double, n_lines long")
    return out.select(
        "doc_id",
        F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "badness",
        "n_lines",
    )
