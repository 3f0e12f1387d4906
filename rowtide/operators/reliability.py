"""Failure runs and redelivery bookkeeping over outcome logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rowtide.operators import classify as C
from rowtide.operators.outcomes import RETRIED

# Defaults of the guard and of redelivery.
GUARD_THRESHOLD_SECONDS = 15 * 60
ACK_WAIT_SECONDS = 30
MAX_DELIVER = 3


def failure_guard(
    out: DataFrame,
    threshold_seconds: int = GUARD_THRESHOLD_SECONDS,
    at: str = "acked_at",
    bucket_seconds: int = 10,
) -> DataFrame:
    """Runs of system failures per consumer, and whether one lasted too long.

    A processed event ends a run; duplicates, skips and data errors neither end
    nor extend it. A run is breached when a failure comes strictly more than the
    threshold after the run's first one. Failures are grouped by the last
    processed event before them, found in two steps so that no task orders a
    whole consumer: inside short time buckets, which hold what one replica can
    finish in that time, and across the buckets' summaries. Events without a
    consumer are one consumer's; a failure without time counts to its first run.
    """
    elapsed = F.unix_micros("last_failure") - F.unix_micros("first_failure")
    return failure_runs(out, at, bucket_seconds).select(
        "consumer_id",
        "first_failure",
        "last_failure",
        "failures",
        (elapsed > threshold_seconds * 1_000_000).alias("breached"),
    )


def failure_runs(out: DataFrame, at: str = "acked_at", bucket_seconds: int = 10) -> DataFrame:
    """The runs of :func:`failure_guard`, with ``since``, the processed event before them (null if there is none)."""
    done = F.struct(F.unix_micros(at).alias("at"), F.col("stream_seq").alias("seq"))
    events = (
        out.filter((F.col("result") == C.PROCESSED) | F.col("result").isin(*RETRIED))
        .select(
            "consumer_id",
            F.col(at).alias("ts"),
            done.alias("pos"),
            (F.col("result") == C.PROCESSED).alias("resets"),
        )
        .withColumn("bucket", F.floor(F.unix_seconds("ts") / F.lit(bucket_seconds)))
    )
    reset_pos = F.when(F.col("resets"), F.col("pos"))
    before = Window.partitionBy("consumer_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        events.groupBy("consumer_id", "bucket")
        .agg(F.max(reset_pos).alias("last_reset"), F.count_if(~F.col("resets")).alias("failures"))
        .withColumn("reset_before", F.max("last_reset").over(before))
        .filter("failures > 0")
        .select(F.col("consumer_id").alias("_consumer"), F.col("bucket").alias("_bucket"), "reset_before")
    )
    there = F.col("consumer_id").eqNullSafe(F.col("_consumer")) & F.col("bucket").eqNullSafe(F.col("_bucket"))
    inside = Window.partitionBy("consumer_id", "bucket").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    runs = (
        events.join(buckets, there)
        .withColumn("reset_inside", F.max(reset_pos).over(inside))
        .filter(~F.col("resets"))
        .withColumn("since", F.coalesce("reset_inside", "reset_before"))
    )
    return runs.groupBy("consumer_id", "since").agg(
        F.min("ts").alias("first_failure"), F.max("ts").alias("last_failure"), F.count("*").alias("failures")
    )


def redelivery_status(
    log: DataFrame,
    message: str = "message",
    delivered: str = "received_at",
    ack_wait_seconds: int = ACK_WAIT_SECONDS,
    max_deliver: int = MAX_DELIVER,
) -> DataFrame:
    """Where each message of a delivery log stands.

    An ack ends a message. A message handed back or left unanswered
    (``disposition`` NULL) is due again after the ack wait until it was
    delivered ``max_deliver`` times, then it is exhausted.
    """
    last = F.max(F.struct(F.col(delivered).alias("at"), F.col("stream_seq"), F.col("disposition"))).alias("last")
    grouped = log.groupBy(message).agg(
        F.count("*").alias("attempts"),
        F.min(delivered).alias("first_delivered_at"),
        last,
        F.coalesce(F.bool_or(F.col("disposition") == "ack"), F.lit(False)).alias("acked"),
    )
    status = (
        F.when(F.col("acked"), "acked")
        .when(F.col("attempts") >= max_deliver, "exhausted")
        .otherwise("pending")
    )
    due = F.col("last.at") + F.make_dt_interval(secs=F.lit(ack_wait_seconds))
    return (
        grouped.withColumn("status", status)
        .select(
            message,
            "attempts",
            "first_delivered_at",
            F.col("last.at").alias("last_delivered_at"),
            F.col("last.disposition").alias("last_disposition"),
            "status",
            F.when(F.col("status") == "pending", due).alias("next_delivery_at"),
        )
    )


def redelivery_schedule(
    log: DataFrame,
    delivered: str = "received_at",
    ack_wait_seconds: int = ACK_WAIT_SECONDS,
    max_deliver: int = MAX_DELIVER,
) -> DataFrame:
    """The delivery times a message can expect if it is never acknowledged.

    One row per first delivery and attempt, with a constant wait between them.
    """
    attempt = F.explode(F.sequence(F.lit(1), F.lit(max_deliver)))
    return log.withColumn("attempt", attempt).withColumn(
        "due_at",
        F.col(delivered) + F.make_dt_interval(secs=(F.col("attempt") - 1) * F.lit(ack_wait_seconds)),
    )
