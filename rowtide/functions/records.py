"""Row images: type checks, typed columns, drift, ids and the JSON event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from rowtide.schemas import DEFAULT_TABLES, SPARK_TYPES, TableSpec, per_table

# Accepted text forms of dates and timestamps.
DATE_FORMAT = "yyyy-MM-dd"
RFC3339_SECONDS = "yyyy-MM-dd'T'HH:mm:ssXXX"
RFC3339_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}T([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d+)?(Z|[+-]([01]\d|2[0-3]):[0-5]\d)$"
)
DEDUP_KEY_PREFIX = "dedup:"

_INTEGER_LIMITS = {"long": (-(2**63), 2**63 - 1), "int": (-(2**31), 2**31 - 1)}


def field(record: Column, name: str, spark_type: str = "variant") -> Column:
    """A field of a row image given as map to VARIANT values."""
    if spark_type == "variant":
        return record[name]
    return F.try_variant_get(record[name], "$", spark_type)


# -- dates ---------------------------------------------------------------------


def blank_date(text: Column) -> Column:
    """Text that stands for "no date"."""
    return text.isNull() | text.isin("", "null")


def parse_date(text: Column) -> Column:
    """``YYYY-MM-DD`` as DATE; NULL for blank or malformed text."""
    return F.when(~blank_date(text), F.try_to_date(text, DATE_FORMAT))


def bad_date(text: Column) -> Column:
    """True for text that is neither blank nor a ``YYYY-MM-DD`` date."""
    return ~blank_date(text) & parse_date(text).isNull()


def format_date(date: Column) -> Column:
    return F.date_format(date, DATE_FORMAT)


def parse_rfc3339(text: Column) -> Column:
    return F.when(text.rlike(RFC3339_PATTERN), F.try_to_timestamp(text))


def format_rfc3339(ts: Column) -> Column:
    return F.date_format(ts, RFC3339_SECONDS)


# -- type checks -----------------------------------------------------------------


# Spark's name of the type that all values of a kind have that needs no closer look.
_PLAIN = {"bool": "BOOLEAN", "string": "STRING", "long": "BIGINT"}


def _mistyped(value: str, kind: str, plain: str) -> str:
    """SQL condition: ``value`` is present, not null, not of the type ``plain`` and not of its kind.

    ``kind`` and ``plain`` are SQL expressions too.
    """
    found, text = f"schema_of_variant({value})", f"try_variant_get({value}, '$', 'string')"
    date = f"{text} IN ('', 'null') OR try_to_date({text}, '{DATE_FORMAT}') IS NOT NULL"
    time = f"{text} RLIKE r'{RFC3339_PATTERN}' AND try_to_timestamp({text}) IS NOT NULL"
    double = f"try_variant_get({value}, '$', 'double')"

    def whole(low: int, high: int) -> str:
        # A number with a zero fraction or an exponent is an integer too.
        number = (
            f"({found} = 'BIGINT' OR ({found} = 'DOUBLE' AND {double} = floor({double}))"
            f" OR ({found} LIKE 'DECIMAL%' AND {text} RLIKE r'^-?[0-9]+([.]0*)?$'))"
        )
        return f"{number} AND try_variant_get({value}, '$', 'decimal(38,0)') BETWEEN {low} AND {high}"

    good = {"date": f"{found} = 'STRING' AND ({date})", "timestamp": f"{found} = 'STRING' AND {time}"}
    good |= {name: whole(*limits) for name, limits in _INTEGER_LIMITS.items()}
    branches = " ".join(f"WHEN '{name}' THEN {condition}" for name, condition in good.items())
    seen = f"coalesce({found} IN ('VOID', {plain}), true)"
    return f"NOT ({seen} OR coalesce(CASE {kind} {branches} END, false))"


def type_errors(record: str, table: str, tables: Sequence[TableSpec] = DEFAULT_TABLES) -> Column:
    """Names of the fields that do not fit the row's table, in schema order.

    ``record`` and ``table`` name the columns with the row image and its table.
    The fields of a table are data that one condition goes through: a condition
    for each of them makes a method too large for the JVM to compile.
    """
    branches = []
    for spec in tables:
        fields = ", ".join(
            f"named_struct('name', '{name}', 'kind', '{kind}', 'plain', '{_PLAIN.get(kind, '')}')"
            for name, kind in spec.fields.items()
            if kind != "any"
        )
        listed = f"CAST(array({fields}) AS array<struct<name: string, kind: string, plain: string>>)"
        branches.append(f"WHEN '{spec.name}' THEN {listed}")
    wrong = _mistyped(f"{record}[field.name]", "field.kind", "field.plain")
    found = f"filter(CASE {table} {' '.join(branches)} END, field -> {wrong})"
    return F.expr(f"transform({found}, field -> field.name)")


def typed_field(record: Column, name: str, kind: str) -> Column:
    if kind == "any":
        return record[name]
    if kind == "date":
        return parse_date(field(record, name, "string"))
    if kind == "timestamp":
        return parse_rfc3339(field(record, name, "string"))
    if kind in _INTEGER_LIMITS:
        return F.coalesce(
            field(record, name, SPARK_TYPES[kind]),
            field(record, name, "decimal(38,0)").try_cast(SPARK_TYPES[kind]),
        )
    return field(record, name, SPARK_TYPES[kind])


def typed_columns(record: Column, spec: TableSpec) -> list[Column]:
    """One typed column per known field; NULL where absent or null."""
    return [typed_field(record, name, kind).alias(name) for name, kind in spec.fields.items()]


# -- drift -------------------------------------------------------------------------


def unhandled_fields(keys: Column, spec: TableSpec) -> Column:
    """Record keys outside the table's known set, sorted."""
    known = F.expr("array(" + ", ".join(f"'{n}'" for n in spec.fields) + ")")
    return F.sort_array(F.array_except(keys, known))


# -- ids and routing ------------------------------------------------------------------


def text_or_empty(record: Column, name: str | None) -> Column:
    if name is None:
        return F.lit("")
    return F.coalesce(field(record, name, "string"), F.lit(""))


def routing_ids(
    record: Column, table_col: str, tables: Sequence[TableSpec] = DEFAULT_TABLES
) -> dict[str, Column]:
    """Primary key and routing ids by name; empty where the table has none."""
    return {
        "pk": per_table(table_col, tables, lambda s: text_or_empty(record, s.pk)),
        "company_id": text_or_empty(record, "company_id"),
        "agent_id": text_or_empty(record, "agent_id"),
        "chat_id": per_table(table_col, tables, lambda s: text_or_empty(record, s.chat)),
        "message_id": per_table(table_col, tables, lambda s: text_or_empty(record, s.message)),
    }


def event_id(commit_lsn: Column, table: Column, pk: Column) -> Column:
    return F.concat_ws(":", commit_lsn.cast("string"), table, pk)


def event_id_table(event: Column) -> Column:
    """The table named in an event id; the key after it may contain colons."""
    parts = F.split(event, ":", 3)
    return F.when(F.size(parts) > 1, F.get(parts, F.lit(1))).otherwise("unknown_table")


def dedup_key(event: Column) -> Column:
    return F.concat(F.lit(DEDUP_KEY_PREFIX), event)


def payload_json(event_time: Column) -> Column:
    """The published JSON event; empty optional ids are left out, nulls in the row stay."""

    def optional(name: str) -> Column:
        return F.when(F.col(name) != "", F.col(name)).alias(name)

    return F.to_json(
        F.struct(
            F.col("event_id"),
            event_time.alias("event_time"),
            F.col("company_id"),
            optional("agent_id"),
            optional("message_id"),
            optional("chat_id"),
            F.col("record").alias("row_data"),
        )
    )
