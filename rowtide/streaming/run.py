"""Streams over the outcome table, each with a checkpoint of its own.

:func:`settle_log` settles deliveries into it, see :mod:`rowtide.streaming.flow`,
which also has the flow as one query. Start the others when it has ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rowtide.operators import classify as C, metrics as M
from rowtide.streaming import flow


def _finish(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def settle_log(
    spark: SparkSession, source: str, out_dir: str, max_files: int = 100, **options
) -> StreamingQuery:
    """Bring the outcome table up to date with the log and stop; options as of :func:`flow.pipeline_stream`."""
    return flow.pipeline_stream(spark, source, out_dir, max_files=max_files, sinks=(), **options)


def _outcome_stream(spark: SparkSession, out_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{out_dir}/outcomes").schema
    return spark.readStream.schema(schema).parquet(f"{out_dir}/outcomes")


def route_events(spark: SparkSession, out_dir: str) -> StreamingQuery:
    """Publish new processed events, laid out by company and table."""
    events = _outcome_stream(spark, out_dir).filter(F.col("result") == C.PROCESSED)
    chosen = events.select(
        "company_id", F.col("payload_table").alias("logical"), "event_id", "target_subject", "payload", "stream_seq"
    )
    # Dealt by folder and 8 parts of it, so that tasks do not each write a file into every folder.
    part = F.pmod(F.xxhash64("event_id"), F.lit(8))
    return _finish(
        chosen.repartition("company_id", "logical", part)
        .writeStream.format("json")
        .option("path", f"{out_dir}/published")
        .option("checkpointLocation", f"{out_dir}/checkpoints/published")
        .partitionBy("company_id", "logical")
        .trigger(availableNow=True)
        .start()
    )


def keep_rejected(spark: SparkSession, out_dir: str) -> StreamingQuery:
    """Append rows refused because of their content to the quarantine table."""
    refused = (C.SUBJECT_ERROR, C.UNMARSHAL_ERROR, C.DATA_ERROR)
    rows = _outcome_stream(spark, out_dir).filter(F.col("result").isin(*refused))
    return _finish(
        rows.select("stream_seq", "received_at", "subject", "result", "error_code", "error_stage", "body", "preview")
        .writeStream.format("parquet")
        .option("path", f"{out_dir}/quarantine")
        .option("checkpointLocation", f"{out_dir}/checkpoints/quarantine")
        .trigger(availableNow=True)
        .start()
    )


def count_outcomes(spark: SparkSession, out_dir: str) -> StreamingQuery:
    """Count new outcomes into the metric tables, a part per micro-batch.

    Parts are sums by label, so a snapshot adds up a few rows per batch and never
    reads the outcomes again. A batch that is run again replaces its part.
    """

    def count(batch: DataFrame, number: int) -> None:
        for name, part in (
            ("summary", M.summary(batch)),
            ("published", M.published_base(batch)),
            ("drift", M.unhandled_fields_total(batch)),
        ):
            part.write.mode("overwrite").parquet(f"{out_dir}/metrics/{name}/batch={number}")

    return _finish(
        _outcome_stream(spark, out_dir)
        .writeStream.foreachBatch(count)
        .option("checkpointLocation", f"{out_dir}/checkpoints/metrics")
        .trigger(availableNow=True)
        .start()
    )


def metrics_snapshot(spark: SparkSession, out_dir: str) -> DataFrame:
    """All metrics as counted so far by :func:`count_outcomes`."""
    parts = [spark.read.parquet(f"{out_dir}/metrics/{name}") for name in ("summary", "published", "drift")]
    return M.snapshot_of(*parts)
