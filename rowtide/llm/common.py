"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowtide.session import materialize

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

__all__ = [
    "SPACE",
    "WORD",
    "drop_table",
    "finished_shuffles_go",
    "fold_of",
    "labelled",
    "materialize",
    "read",
    "release",
    "table_bytes",
    "words_of",
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words_of(text: Column) -> Column:
    """Maximal runs of characters that are no ASCII white space; null has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, f"{SPACE}+"))


def fold_of(doc_id: Column, folds: int) -> Column:
    """``crc32`` of the id as text, modulo ``folds``; null ids are in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled(labels: DataFrame, label: str, fit_rows: int, folds: int = 5) -> DataFrame:
    """``(doc_id, label)`` to learn from: outside fold 0, about ``fit_rows`` rows at most.

    Repeated labels of a document count once, as their largest; rows without an
    id or a label are left out. The sample is taken by a hash of the id, so it
    is the same in every run. Its bound makes it small enough to broadcast.
    """
    rows = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .filter(fold_of(F.col("doc_id"), folds) != 0)
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    there = rows.count()
    if there > fit_rows:
        share = int(1_000_000 * fit_rows / there)
        rows = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000)) < share)
    return rows


def table_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of ``df``; exact to the file for a materialized table."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that :func:`materialize` wrote and nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps: it does so when the driver collects their handles."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def finished_shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Inside the block Spark deletes the shuffle files of each query as soon as it ends.

    For steps that write tables: what they shuffled is of no use once the table
    is there. DataFrames that are run later are best made after the block.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
