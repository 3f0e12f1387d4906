"""Per-message checks, from the subject to the routed event, as one narrow stage.

``classify`` turns raw messages into rows that either carry an event id and a
target subject or an ``error_code``. Every step is a projection, so it runs the
same on a batch and on a stream and never shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowtide.functions import records as R
from rowtide.functions.envelope import decode_envelope
from rowtide.functions.settle import settled
from rowtide.functions.subjects import parse_subject, target_subject
from rowtide.schemas import DEFAULT_TABLES, TableSpec, per_table, table_names
from rowtide.session import check_settings

# Outcome labels, error stages and the label of unreadable subjects.
BAD_SUBJECT_TABLE = "unknown_subject_format"
PROCESSED = "processed"
DUPLICATE = "duplicate"
SKIPPED = "skipped"
SUBJECT_ERROR = "error"
UNMARSHAL_ERROR = "unmarshal_error"
DATA_ERROR = "transform_data_error"
SYSTEM_ERROR = "transform_system_error"
DEDUP_ERROR = "dedup_error"
PUBLISH_ERROR = "publish_error"
STAGE_OF_CODE = {
    "empty_table_name": "empty_metadata_table_name",
    "null_record": "populate_typed_data",
    "type_mismatch": "unmarshal_to_typed_data",
    "empty_pk": "extract_pk",
}
PREVIEW_BYTES = 64


def with_subject(df: DataFrame, tables: Sequence[TableSpec] = DEFAULT_TABLES) -> DataFrame:
    """Add ``subject_info``, ``subject_table`` and ``allowed``."""
    info = F.col("subject_info")
    return parse_subject(df).withColumns(
        {
            "subject_table": F.when(info["is_valid"], info["table_name"]),
            "allowed": info["is_valid"] & info["table_name"].isin(table_names(tables)),
        }
    )


def with_envelope(df: DataFrame, data: str = "data") -> DataFrame:
    """Decode the body of allowed rows and name its authoritative table."""
    decoded = decode_envelope(
        df.withColumn("body", F.col(data)),
        data,
        only_if=F.col("allowed"),
        keep=("table_name", "commit_lsn"),
    )
    return decoded.withColumnRenamed("table_name", "payload_table")


def table_mismatch() -> Column:
    """True where subject and payload disagree; the payload's table is used."""
    return F.col("payload_table") != F.col("subject_table")


def with_record(df: DataFrame, tables: Sequence[TableSpec] = DEFAULT_TABLES) -> DataFrame:
    """Type-check the row image, list its drift and take its ids.

    Drift and ids exist only for rows that fit their table, as nothing can be
    read from a row of the wrong shape.
    """
    rec = F.col("record")
    errors = R.type_errors("record", "payload_table", tables)
    checked = df.withColumn("type_errors", F.when(rec.isNotNull(), errors))
    fits = F.size("type_errors") == 0
    drift = per_table("payload_table", tables, lambda s: R.unhandled_fields(F.map_keys(rec), s))
    ids = R.routing_ids(rec, "payload_table", tables)
    read = checked.withColumns(
        {
            "unhandled_fields": F.when(fits, drift),
            **{name: F.when(fits, value) for name, value in ids.items()},
        }
    )
    return settled(read, "type_errors", "unhandled_fields", *ids)


def error_code(tables: Sequence[TableSpec] = DEFAULT_TABLES, at: str | None = None) -> Column:
    """The first check a row fails, in order; NULL for a routable row.

    ``at`` names the arrival time, without which no delivery can be told from
    its redelivery.
    """
    per_chat = [s.name for s in tables if s.per_chat]
    arrived = F.lit(True) if at is None else F.col(at).isNotNull()
    return (
        F.when(~F.col("subject_info.is_valid"), "invalid_subject")
        .when(~F.col("allowed"), "table_not_allowed")
        .when(~F.col("decodable"), "undecodable")
        .when(F.col("payload_table") == "", "empty_table_name")
        .when(~F.col("payload_table").isin(table_names(tables)), "unknown_table")
        .when(F.col("type_errors").isNull(), "null_record")
        .when(F.size("type_errors") > 0, "type_mismatch")
        .when(F.col("pk") == "", "empty_pk")
        .when(F.col("company_id") == "", "missing_company_id")
        .when(F.col("agent_id") == "", "empty_agent_id")
        .when(F.col("payload_table").isin(per_chat) & (F.col("chat_id") == ""), "missing_chat_id")
        .when(~arrived, "missing_arrival_time")
    )


def _lookup(key: Column, values: dict[str, str]) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out


def result_of_code(code: Column) -> Column:
    return (
        F.when(code == "invalid_subject", SUBJECT_ERROR)
        .when(code == "table_not_allowed", SKIPPED)
        .when(code == "undecodable", UNMARSHAL_ERROR)
        .when(code.isNotNull(), DATA_ERROR)
    )


def classify(
    raw: DataFrame,
    tables: Sequence[TableSpec] = DEFAULT_TABLES,
    data: str = "data",
    at: str = "received_at",
) -> DataFrame:
    """Run all per-message checks.

    Input columns other than the body pass through. ``result`` is set for rows
    that end here and NULL for rows that go on to deduplication, which have
    ``event_id`` and ``target_subject``. Rows that end here because of their
    content keep their whole body in ``body``, and its first bytes in ``preview``.
    """
    check_settings(raw.sparkSession)
    checked = with_record(with_envelope(with_subject(raw, tables), data), tables)
    coded = settled(checked.withColumn("error_code", error_code(tables, at if at in raw.columns else None)), "error_code")
    code = F.col("error_code")
    event = R.event_id(F.col("commit_lsn"), F.col("payload_table"), F.col("pk"))
    out = coded.withColumns(
        {
            "result": result_of_code(code),
            "error_stage": _lookup(code, STAGE_OF_CODE),
            "error_table": F.when(result_of_code(code) == DATA_ERROR, F.when(
                code == "empty_table_name", F.col("subject_table")
            ).otherwise(F.col("payload_table"))),
            "event_id": F.when(code.isNull(), event),
            "target_subject": F.when(code.isNull(), target_subject("payload_table", tables)),
            "result_table": F.coalesce(F.col("subject_table"), F.lit(BAD_SUBJECT_TABLE)),
            "body": F.when(code.isNotNull() & (code != "table_not_allowed"), F.col("body")),
        }
    ).withColumn("preview", F.substring(F.col("body").cast("binary"), 1, PREVIEW_BYTES))
    return out.drop("subject_info", "allowed", "decodable")


def quarantine(raw: DataFrame, tables: Sequence[TableSpec] = DEFAULT_TABLES) -> DataFrame:
    """Rows that are acknowledged but never published because of their content."""
    return classify(raw, tables).filter(
        F.col("result").isin(SUBJECT_ERROR, UNMARSHAL_ERROR, DATA_ERROR)
    )
