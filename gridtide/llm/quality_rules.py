"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule rejects a document by a condition on its measures. Rules are costed and their rejection rate is measured on a
sample; the cascade then asks the rule with most rejections per unit of cost first, and a document that one rule
rejects is not put to the next. The order changes the work, never the verdict.

Defined results: a null or blank text has no words and fails the base rule; repeated rows are judged each on its own;
an empty table gives an empty result; columns of the input that have the name of a measure are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD, bind, forget, words, written

SYMBOLS = "[#*$%&|<>]"


def word_chars(word_array: Column) -> Column:
    """Code points that belong to words."""
    return F.length(F.array_join(word_array, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOLS)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    return bind(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long")


def n_repeat_words(word_array: Column, window: int = 3) -> Column:
    """Words that lie in a window of ``window`` words found at least twice in the text, the first one included.

    Windows are sorted with their places, so equal ones are neighbours; the places of repeated windows, sorted
    again, cover as many words as the gap to the next place, at most a whole window. A window is held by its 64-bit
    hash: within one text of 100,000 words two different windows share one with a chance below 1e-9.
    """

    def places(a: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(a) - window, F.lit(0)))
        gram = lambda i: F.xxhash64(*[F.get(a, i + k) for k in range(window)])
        return bind(F.sort_array(F.transform(starts, lambda i: F.struct(gram(i).alias("gram"), i.alias("at")))), repeated)

    def repeated(s: Column) -> Column:
        # an index outside the array gives null, which equals nothing
        again = F.filter(s, lambda x, k: (x["gram"] == F.get(s, k - 1)["gram"]) | (x["gram"] == F.get(s, k + 1)["gram"]))
        return bind(F.sort_array(F.transform(again, lambda x: x["at"])), covered)

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(window)), F.lit(window)))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    return F.when(F.size(word_array) <= window, F.lit(0)).otherwise(bind(word_array, places)).cast("long")


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the word array (``words_``) and the five counts that the base rule and the report use."""
    clean = F.coalesce(F.col(text), F.lit(""))
    return df.withColumns(
        {
            "words_": words(F.col(text)),
            "n_symbols": n_symbols(clean),
            "n_dup_lines": n_dup_lines(clean),
        }
    ).withColumns(
        {
            "n_words": F.size("words_").cast("long"),
            "word_chars": word_chars(F.col("words_")),
            "n_repeat_words": n_repeat_words(F.col("words_")),
        }
    )


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a condition on the columns of ``measures`` and the text; null counts as no rejection."""

    name: str
    rejects: Column


def base_rule() -> Rule:
    return Rule("base", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))


def standard_rules(text: str = "text") -> list[Rule]:
    """Rules whose limits clean prose stays far from; each is a ratio of counts over the whole text."""
    body = F.coalesce(F.col(text), F.lit(""))
    count = F.col("n_words")
    lines = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(WORD))
    odd_words = F.regexp_count(body, F.lit(rf"(?<!{WORD[:-1]})[^\p{{L}}\x20\x09-\x0D]++(?!{WORD[:-1]})"))
    long_words = F.size(F.filter("words_", lambda w: F.length(w) > 40))
    return [
        Rule("symbols", F.col("n_symbols") * 10 > count),
        Rule("mean_word_length", (F.col("word_chars") < 2 * count) | (F.col("word_chars") > 12 * count)),
        Rule("words_without_letters", odd_words * 5 > count),
        Rule("endless_words", long_words * 20 > count),
        Rule("repeated_lines", (F.col("n_dup_lines") > 3) & (F.col("n_dup_lines") * 2 > F.size(lines))),
        Rule("one_word_over_and_over", F.size(F.array_distinct("words_")) * 10 < F.sqrt(count.cast("double")) * 20),
        Rule("bullet_lines", F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•]"))) * 10 > F.size(lines) * 9),
    ]


@dataclass(frozen=True)
class Estimate:
    """``seconds`` for one row."""

    name: str
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-8)


#: Rows that rules are estimated on, and how often a rule is put to each of them in one timed job.
SAMPLE_ROWS, REPEATS, TIMED_RUNS = 500, 20, 2


def sampled(df: DataFrame, text: str, rows: int) -> DataFrame:
    """Texts of ``rows`` rows chosen by a hash of text and place, written in one partition.

    First the hashes alone are ordered, then the rows up to the last of them are read: no text passes the driver.
    """
    hashed = df.select(text, F.xxhash64(F.col(text), F.monotonically_increasing_id()).alias("hash_"))
    last = hashed.select("hash_").orderBy("hash_").limit(rows).agg(F.max("hash_")).first()[0]
    chosen = hashed.where(F.col("hash_") <= F.lit(last)) if last is not None else hashed.limit(0)
    return written(chosen.select(text).coalesce(1), "rule-sample")


def estimate(df: DataFrame, rules: Sequence[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Seconds for one row and rejection rate of each rule, on a sample of at most ``sample_rows`` rows.

    The sample only orders the rules. A rule is put ``REPEATS`` times to every sampled row in a job of one task; what a
    rule that never rejects takes in the same job is launching and reading, and is taken off. The least time of a few
    runs counts.
    """
    held = written(measures(sampled(df, text, sample_rows), text), "rule-measures").coalesce(1)
    n = held.count()
    if not n:
        return [Estimate(r.name, 0.0, 0.0) for r in rules]
    many = held.withColumn("again_", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def timed(rejects: Column) -> tuple[float, float]:
        took = []
        for _ in range(TIMED_RUNS):
            began = time.perf_counter()
            hit = many.agg(F.avg(F.coalesce(rejects, F.lit(False)).cast("double"))).first()[0]
            took.append(time.perf_counter() - began)
        return min(took), hit or 0.0

    # reads what the rules read, so that only asking them is left of the difference
    empty = timed(F.length(text) + F.size("words_") + F.col("n_symbols") < 0)[0]
    found = []
    for rule in rules:
        seconds, hit = timed(rule.rejects)
        found.append(Estimate(rule.name, max(seconds - empty, 0.0) / (n * REPEATS), hit))
    forget(held)
    return found


def ordered(rules: Sequence[Rule], estimates: Sequence[Estimate]) -> list[Rule]:
    """Most rejections per second first; ties, and rules that reject nothing of the sample, by cost."""
    by_name = {e.name: e for e in estimates}
    return sorted(rules, key=lambda r: (-by_name[r.name].worth, by_name[r.name].seconds, r.name))


def cascade(rules: Sequence[Rule]) -> Column:
    """The name of the first rule that rejects, or null. Later branches are not evaluated once one holds."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name)).otherwise(verdict)
    return verdict


def judge(
    df: DataFrame,
    rules: Sequence[Rule] | None = None,
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    estimates: Mapping[str, Estimate] | None = None,
) -> DataFrame:
    """``df`` with its measures, ``base_failed``, ``rejected_by`` (first rule in the chosen order) and ``kept``.

    The base rule stands first since its measures are part of the result.
    """
    rules = list(standard_rules(text) if rules is None else rules)
    found = list(estimates.values()) if estimates else estimate(df, rules, text, sample_rows)
    measured = measures(df, text).withColumn("base_failed", base_rule().rejects)
    verdict = F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(ordered(rules, found)))
    return measured.withColumn("rejected_by", verdict).withColumn("kept", F.col("rejected_by").isNull())
