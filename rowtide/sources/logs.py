"""Captured logs as batch or streaming DataFrames, and the event sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.functions.subjects import layout_filter, matches_pattern

MAX_FILES_PER_TRIGGER = 100
LOG_SCHEMA = (
    "subject string, data string, stream_seq bigint, received_at timestamp, "
    "consumer_id string, duration_s double, sink_ok boolean, dedup_ok boolean, acked_at timestamp"
)


def read_log(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = LOG_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)


def stream_log(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: str = LOG_SCHEMA,
    max_files: int = MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    """The log as a stream from its beginning, a bounded number of files at a time.

    Progress is acknowledged by the checkpoint of the query that reads it.
    """
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files).load(path)


def routed_rows(events: DataFrame) -> DataFrame:
    """Key and value for a message sink: the target subject and the JSON event."""
    return events.select(F.col("target_subject").alias("key"), F.col("payload").alias("value"))


def send(events: DataFrame, fmt: str, **options: str) -> None:
    """Append events as key and value to any sink Spark can write, for example a message broker's."""
    routed_rows(events).write.format(fmt).options(**options).mode("append").save()


LAYOUT_SCHEMA = "event_id string, stream_seq bigint, target_subject string, payload string, company_id string, logical string"


def write_routed(events: DataFrame, path: str) -> None:
    """Events as JSON lines, laid out so that a reader can take one company or stream.

    Folders are named by the second and fourth token of the target subject, so
    that a subject pattern says exactly which ones can match. Rows are first
    brought together by folder in partitions of even size: adaptive execution
    splits those of a company with most of the events and joins small ones, so
    no task writes a hot folder alone and files stay few. Chat ids are not part
    of the layout; they would make a folder per chat.
    """
    tokens = F.split("target_subject", r"\.", -1)
    kept = [c for c in ("event_id", "stream_seq", "target_subject", "payload") if c in events.columns]
    (
        events.select(F.get(tokens, F.lit(1)).alias("company_id"), F.get(tokens, F.lit(3)).alias("logical"), *kept)
        .hint("rebalance", "company_id", "logical")
        .write.mode("append")
        .partitionBy("company_id", "logical")
        .json(path)
    )


def read_routed(spark: SparkSession, path: str, patterns: str) -> DataFrame:
    """The events of a layout whose target subject matches any pattern of a comma-separated list.

    Only folders that the patterns can match are listed in the scan; the rest of
    a pattern is checked on the rows that are read.
    """
    there = spark.read.schema(LAYOUT_SCHEMA).json(path)
    return there.filter(layout_filter(patterns)).filter(matches_pattern(F.col("target_subject"), patterns))
