"""The registered queries of the subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.llm import (
    conversation_repair,
    decontaminate,
    lexical_search,
    line_dedup,
    maxent_lm,
    minhash,
    packing,
    quality_rules,
    quality_trees,
    source_mix,
    suffix_dedup,
    token_counts,
    toxicity,
)
from rowtide.llm.common import read


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_verdicts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "rule",
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(docs, vocabulary)


def op4_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_trees.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=2)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer)


def op7_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.language_scores(read(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(read(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return line_dedup.drop_lines(docs).select("doc_id", "n_lines", "n_removed", kept)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = read(spark, sf_dir, "conversations")
    return conversation_repair.structure_report(conversation_repair.damage(talks), talks)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_sources(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_toxicity": op2_toxicity,
    "op3_token_counts": op3_token_counts,
    "op4_quality_trees": op4_quality_trees,
    "op5_minhash": op5_minhash,
    "op6_packing": op6_packing,
    "op7_maxent_lm": op7_maxent_lm,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_decontaminate": op9_decontaminate,
    "op10_line_dedup": op10_line_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_lexical_search": op12_lexical_search,
    "op13_source_mix": op13_source_mix,
}

ORACLE: dict[str, str] = {
    "op5_minhash": minhash.SQL,
    "op8_suffix_dedup": suffix_dedup.SQL,
    "op9_decontaminate": decontaminate.SQL,
    "op10_line_dedup": line_dedup.SQL,
    "op12_lexical_search": lexical_search.SQL,
    "op13_source_mix": source_mix.SQL,
}
