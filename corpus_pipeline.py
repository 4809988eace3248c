"""Corpus pipeline: toxic documents go, one of each group of near copies stays, benchmark leaks go, the rest is mixed
to target weights and written as token shards.

A stage is a function of (spark, docs, sf_dir). Its result is written as Parquet and read again as the next one's docs.
All stages but the last return the columns of ``documents``; the last returns the index of the token shards. Rows with
one id share the fate of that id in the filtering stages; rows without an id stay. An empty table passes through.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from gridtide.llm import decontaminate, jaccard_join, mixing, queries, token_output, toxicity
from gridtide.llm.common import forget, read_in_pieces, table, written

MIX_FRACTION = 0.9
#: Near copies of the stage share 80 % of their five-word shingles; the values of jaccard_join are those of op3.
NEAR_WORDS, NEAR_SHARE = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_pieces(stage: Stage) -> Stage:
    """The texts of a stage are read when its result is written, by whoever called it, so the session is told before."""

    @wraps(stage)
    def told(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read_in_pieces(spark)
        return stage(spark, docs, sf_dir)

    return told


@in_pieces
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


@in_pieces
def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs, k=NEAR_WORDS, share=NEAR_SHARE)


@in_pieces
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@in_pieces
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    stated = (queries.MIX_DOMAINS, queries.MIX_LANGS)
    return mixing.mix(docs, fraction=MIX_FRACTION, max_epochs=1, seed=queries.MIX_SEED, stated=stated).drop("epoch")


@in_pieces
def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_output.encoded(docs, queries.word_bpe())


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

#: SQL can express neither the classifier nor the tokenizer; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, written(stage(spark, docs, sf_dir), name)
        forget(before)  # a no-op for the given table
    return docs
