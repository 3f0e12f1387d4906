from __future__ import annotations

import datetime as dt
import json

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)

MESSAGE = {
    "agent_id": "agent-a7",
    "chat_id": "chat-b8",
    "message_id": "msg-c9",
    "company_id": "company-d0",
}


def subject(table: str, action: str = "insert") -> str:
    return f"sequin.changes.appdb.public.{table}.{action}"


def body(table, record, lsn=1632321, **extra) -> str:
    meta = {"table_schema": "public", "table_name": table, "commit_lsn": lsn, **extra.pop("metadata", {})}
    return json.dumps({"record": record, "action": "insert", "metadata": meta, **extra})


def log(spark, rows):
    """Rows of (subject, data) or (subject, data, offset seconds, sink_ok)."""
    full = []
    for i, row in enumerate(rows):
        subj, data, offset, ok = (*row, i, True)[:4] if len(row) == 2 else (*row, True)[:4]
        at = T0 + dt.timedelta(seconds=offset)
        full.append((subj, data, i, at, "c0", 0.01, ok, at + dt.timedelta(milliseconds=10)))
    return spark.createDataFrame(
        full,
        "subject string, data string, stream_seq bigint, received_at timestamp, consumer_id string, "
        "duration_s double, sink_ok boolean, acked_at timestamp",
    )
