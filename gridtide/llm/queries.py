"""The operators as registered queries, each over the whole of its tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    chat,
    decontaminate,
    html_text,
    jaccard_join,
    mixing,
    prefix_trie,
    quality_crf,
    quality_rules,
    secret_scans,
    sharding,
    token_output,
    toxicity,
    vector_codes,
)
from .common import table


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def word_bpe() -> str:
    """The place of the tokenizer file; the package that holds it is installed with the public vocabularies."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.encoded(table(spark, sf_dir, "documents"), word_bpe())


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.joined(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    shared = chat.with_turns(turns, chat.opening_pairs(turns))
    pairs = chat.format_pairs(shared.unionByName(chat.swapped_endings(turns)))
    # spans as text, "begin-end,begin-end", which both engines write alike
    written = lambda c: F.array_join(
        F.transform(c, lambda s: F.concat(s["begin"].cast("string"), F.lit("-"), s["end"].cast("string"))), ","
    )
    return pairs.withColumns({c: written(c) for c in ("chosen_spans", "rejected_spans")})


MIX_SEED = 7
#: Target weights of the mixture, stated by domain and by language; names that stand in neither weigh 1.
MIX_DOMAINS = {"src": 2.0, "src1": 1.0}
MIX_LANGS = {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0}


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.measured(table(spark, sf_dir, "documents"))
    weights = mixing.weight_table(rows, MIX_DOMAINS, MIX_LANGS)
    plan = mixing.leaf_plan(rows, fraction=0.9, weights=weights, max_epochs=2, seed=MIX_SEED)
    taken = mixing.chosen(rows, plan, MIX_SEED, "id_")
    levels = [f"leaf_{c}" for c in mixing.LEVELS]
    budgets = plan.select(*levels, F.col("budget").alias("leaf_budget"))
    return taken.join(budgets, levels).select(
        F.col("id_").alias("doc_id"),
        F.col("leaf_domain").alias("domain"),
        F.col("leaf_lang").alias("lang"),
        F.col("leaf_source").alias("source"),
        "epoch",
        "n_tokens",
        "leaf_budget",
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.coded(table(spark, sf_dir, "embeddings"))


def op13_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.scanned(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality_crf": op2_quality_crf,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_html_extraction": op4_html_extraction,
    "op5_sharding": op5_sharding,
    "op6_token_output": op6_token_output,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_quality_rules": op9_quality_rules,
    "op10_mixing": op10_mixing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_vector_codes": op12_vector_codes,
    "op13_secret_scans": op13_secret_scans,
}
