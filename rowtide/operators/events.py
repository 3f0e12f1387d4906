"""Published events and their layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowtide.functions.records import format_rfc3339, payload_json
from rowtide.operators import classify as C


def enriched(routed: DataFrame, stamp: str | None = None) -> DataFrame:
    """Routable rows as events with their JSON payload.

    ``stamp`` names the column to use as processing time; without it the current
    time is taken.
    """
    at = F.col(stamp) if stamp else F.current_timestamp()
    events = routed.withColumn("event_time", format_rfc3339(at))
    return events.withColumn("payload", payload_json(F.col("event_time"))).select(
        "event_id",
        "event_time",
        "company_id",
        "agent_id",
        "chat_id",
        "message_id",
        F.col("payload_table").alias("logical"),
        "target_subject",
        F.col("record").alias("row_data"),
        "payload",
        "stream_seq",
        "received_at",
    )


def published(out: DataFrame, stamp: str | None = None) -> DataFrame:
    """The events of an outcome table that reached the sink."""
    return enriched(out.filter(F.col("result") == C.PROCESSED), stamp)
