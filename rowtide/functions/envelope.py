"""Strict decoding of the JSON change envelope.

Spark's JSON reader is more forgiving than the envelope's definition allows: it
turns numbers into strings and ignores text after the document. So the body is
embedded in an outer object whose last key must still be there after parsing,
scalar fields are read as VARIANT and their types checked, and a value of the
wrong shape shows in the corrupt-record column. The text is parsed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowtide.functions.settle import settled

# Envelope fields and their JSON types.
STRING_FIELDS = (
    "action",
    "metadata.table_schema",
    "metadata.table_name",
    "metadata.commit_timestamp",
    "metadata.idempotency_key",
    "metadata.sink.id",
    "metadata.sink.name",
)
INTEGER_FIELDS = ("metadata.commit_lsn",)
ENVELOPE = (
    "doc struct<"
    "record map<string,variant>, changes map<string,variant>, action variant, "
    "metadata struct<"
    "table_schema variant, table_name variant, commit_timestamp variant, commit_lsn variant, "
    "idempotency_key variant, transaction_annotations map<string,variant>, "
    "sink struct<id variant, name variant>>>, "
    "__end__ int, _corrupt_record string"
)
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def json_type_in(value: Column, *names: str) -> Column:
    """True where the value is absent, JSON null or of one of Spark's named types."""
    return F.coalesce(F.schema_of_variant(value).isin("VOID", *names), F.lit(True))


def column_of(path: str) -> str:
    return path.removeprefix("metadata.").replace(".", "_")


ENVELOPE_COLUMNS = tuple(column_of(path) for path in STRING_FIELDS + INTEGER_FIELDS)


def _outer(data: Column) -> Column:
    return F.concat(F.lit('{"doc":'), data, F.lit(',"__end__":1}'))


def parse_body(data: Column) -> Column:
    return F.from_json(_outer(data), ENVELOPE, _STRICT)


def is_alone(data: Column) -> Column:
    """True if a body that :func:`parse_body` could read is one value, with nothing after it.

    What follows the value goes on with a comma or closes the outer object, and
    so hides the rest from the reader. In an array the one makes a second element
    and the other is no JSON; what closes the array is none in the outer object.
    """
    return F.coalesce(F.json_array_length(F.concat(F.lit("["), data, F.lit("]"))) == 1, F.lit(False))


def last_of_each_key(record: Column, data: Column) -> Column:
    """The row image with the last value of every key.

    A parsed map keeps repeated keys, a parsed VARIANT resolves them; only a
    row that has some is parsed a second time.
    """
    unique = F.size(F.array_distinct(F.map_keys(record))) == F.size(record)
    again = F.try_variant_get(F.try_parse_json(data), "$.record", "map<string,variant>")
    return F.when(record.isNull() | unique, record).otherwise(again)


def decode_envelope(
    df: DataFrame,
    data: str = "data",
    only_if: Column | None = None,
    keep: Sequence[str] = ENVELOPE_COLUMNS,
) -> DataFrame:
    """Replace the body by ``decodable``, ``record`` and the ``keep`` columns.

    ``only_if`` keeps rows that are known to be dropped from being parsed at
    all; they come out with ``decodable`` NULL. An envelope that is JSON null
    decodes to empty values. Missing strings are ``''``, a missing commit
    position is 0. ``record`` maps the row image's keys to VARIANT values, NULL
    without a row image.
    """
    attempted = F.lit(True) if only_if is None else only_if
    j = F.col("_json")
    parsed = df.withColumn("_json", F.when(attempted, parse_body(F.col(data))))

    def at(path: str) -> Column:
        value = j["doc"]
        for name in path.split("."):
            value = value[name]
        return value

    ok = j["_corrupt_record"].isNull() & (j["__end__"] == 1)
    for path in STRING_FIELDS:
        ok = ok & json_type_in(at(path), "STRING")
    for path in INTEGER_FIELDS:
        ok = ok & json_type_in(at(path), "BIGINT")
    ok = ok & is_alone(F.col(data))  # the last condition: bodies that fail another are not read again
    checked = parsed.withColumn("decodable", F.when(attempted, F.coalesce(ok, F.lit(False))))

    good = F.col("decodable")
    columns = {"record": F.when(good, last_of_each_key(at("record"), F.col(data)))}
    for path in STRING_FIELDS:
        text = F.coalesce(F.try_variant_get(at(path), "$", "string"), F.lit(""))
        columns[column_of(path)] = F.when(good, text)
    for path in INTEGER_FIELDS:
        number = F.coalesce(F.try_variant_get(at(path), "$", "bigint"), F.lit(0).cast("bigint"))
        columns[column_of(path)] = F.when(good, number)
    wanted = {name: value for name, value in columns.items() if name == "record" or name in keep}
    read = checked.withColumns(wanted).drop("_json", data)
    return settled(read, "decodable", *wanted)
