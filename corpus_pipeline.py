"""The corpus pipeline: filter, clean, deduplicate, decontaminate and pack ``documents``.

Each stage is one operator of ``rowtide.llm``; its rows are written as Parquet
and are the next one's documents. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rowtide.llm import decontaminate, line_dedup, minhash, packing, quality_rules
from rowtide.llm.common import read
from rowtide.session import shared_dir


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned quality rules keep."""
    return quality_rules.keep_good(docs, read(spark, sf_dir, "labels"))


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that nearly repeat earlier ones; those with nothing else go."""
    return line_dedup.clean_lines(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8)."""
    return minhash.keep_one(docs)


def unseen_by_tests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good_documents),
    ("line_dedup", new_lines),
    ("near_duplicates", one_of_each),
    ("decontamination", unseen_by_tests),
    ("packing", packed),
]

# Learned rules and a genetic search have no SQL form; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each one's rows are written and reread."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
