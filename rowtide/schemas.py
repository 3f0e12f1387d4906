"""Table registry: which tables are processed, and what their rows look like.

A table is data, not code: add a :class:`TableSpec` to the list passed to the
operators and every one of them (type checks, drift, event ids, routing)
handles the new table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

SPARK_TYPES = {
    "string": "string",
    "long": "bigint",
    "int": "int",
    "bool": "boolean",
    "timestamp": "timestamp",
    "date": "date",
    "any": "variant",
}


@dataclass(frozen=True)
class TableSpec:
    """One source table.

    ``fields`` maps each known column to its kind (a key of ``SPARK_TYPES``).
    ``pk`` names the column that identifies a row in event ids. ``chat`` and
    ``message`` name the columns copied into the event's routing ids, and
    ``per_chat`` puts the chat id at the end of the target subject, which makes
    it a required value.
    """

    name: str
    fields: dict[str, str]
    pk: str
    chat: str | None = None
    message: str | None = None
    per_chat: bool = False

    def field_names(self) -> list[str]:
        return list(self.fields)

    def struct_type(self) -> T.StructType:
        ddl = ", ".join(f"`{n}` {SPARK_TYPES[k]}" for n, k in self.fields.items())
        return T.StructType.fromDDL(ddl)


# Column names and types of the four processed tables.
AGENTS = TableSpec(
    name="agents",
    pk="agent_id",
    fields={
        "id": "long",
        "agent_id": "string",
        "company_id": "string",
        "qr_code": "string",
        "status": "string",
        "agent_name": "string",
        "host_name": "string",
        "version": "string",
        "created_at": "timestamp",
        "updated_at": "timestamp",
    },
)
CHATS = TableSpec(
    name="chats",
    pk="chat_id",
    chat="chat_id",
    fields={
        "id": "long",
        "chat_id": "string",
        "agent_id": "string",
        "company_id": "string",
        "jid": "string",
        "custom_name": "string",
        "push_name": "string",
        "is_group": "bool",
        "group_name": "string",
        "unread_count": "int",
        "assigned_to": "string",
        "last_message": "any",
        "conversation_timestamp": "long",
        "phone_number": "string",
    },
)
MESSAGES = TableSpec(
    name="messages",
    pk="message_id",
    chat="chat_id",
    message="message_id",
    per_chat=True,
    fields={
        "id": "long",
        "message_id": "string",
        "chat_id": "string",
        "agent_id": "string",
        "company_id": "string",
        "from_user": "string",
        "to_user": "string",
        "jid": "string",
        "flow": "string",
        "type": "string",
        "message_obj": "any",
        "edited_message_obj": "any",
        "key": "any",
        "status": "string",
        "is_deleted": "bool",
        "message_timestamp": "long",
        "message_date": "date",
    },
)
CONTACTS = TableSpec(
    name="contacts",
    pk="id",
    fields={
        "id": "string",
        "phone_number": "string",
        "company_id": "string",
        "agent_id": "string",
        "custom_name": "string",
        "assigned_to": "string",
    },
)

DEFAULT_TABLES: tuple[TableSpec, ...] = (AGENTS, CHATS, MESSAGES, CONTACTS)


def known_fields(spark: SparkSession, tables: Sequence[TableSpec] = DEFAULT_TABLES) -> DataFrame:
    """The known-field catalogue, one row per (table, field)."""
    rows = [
        (t.name, pos, name, SPARK_TYPES[kind])
        for t in tables
        for pos, (name, kind) in enumerate(t.fields.items())
    ]
    return spark.createDataFrame(rows, "table string, position int, field string, type string")


def table_names(tables: Sequence[TableSpec]) -> list[str]:
    return [t.name for t in tables]


def per_table(table_col, tables: Sequence[TableSpec], expr):
    """``CASE table WHEN ... THEN expr(spec)``; NULL for other tables."""
    out = None
    for spec in tables:
        value = expr(spec)
        cond = F.col(table_col) == spec.name
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out
