"""Routing subjects: parsing, pattern matching and building."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowtide.schemas import DEFAULT_TABLES, TableSpec, per_table, table_names

# Fixed values: <two-token prefix>.<database>.<schema>.<table>.<action>
SUBJECT_PREFIX = "sequin.changes"
SUBJECT_TOKENS = 6
TARGET_PREFIX = "websocket"


def parse_subject(df: DataFrame, subject: str = "subject", prefix: str = SUBJECT_PREFIX) -> DataFrame:
    """Add the struct column ``subject_info``.

    Tokens that were not reached stay empty: a wrong token count fills nothing,
    a wrong prefix fills only ``prefix``. ``is_valid`` needs the right count and
    prefix and four non-empty tokens.
    """
    raw = F.coalesce(F.col(subject), F.lit(""))
    tokens = df.withColumn("_tokens", F.split(raw, r"\.", -1))
    t = F.col("_tokens")
    six = F.size(t) == SUBJECT_TOKENS
    head = F.concat_ws(".", F.slice(t, 1, 2))
    ours = six & (head == prefix)
    full = ours
    for i in range(2, SUBJECT_TOKENS):
        full = full & (F.get(t, F.lit(i)) != "")

    def token(i: int) -> Column:
        return F.when(ours, F.get(t, F.lit(i))).otherwise("")

    return tokens.withColumn(
        "subject_info",
        F.struct(
            F.col(subject).alias("raw"),
            F.when(six, head).otherwise("").alias("prefix"),
            token(2).alias("database_name"),
            token(3).alias("schema_name"),
            token(4).alias("table_name"),
            token(5).alias("action"),
            full.alias("is_valid"),
        ),
    ).drop("_tokens")


def pattern_to_regex(pattern: str) -> str:
    """``*`` stands for one token, a trailing ``>`` for one or more."""
    tokens = pattern.strip().split(".")
    out = []
    for i, token in enumerate(tokens):
        if token == "*":
            out.append(r"[^.]+")
        elif token == ">" and i == len(tokens) - 1:
            out.append(r"[^.]+(?:\.[^.]+)*")
        else:
            out.append(re.escape(token))
    return "^" + r"\.".join(out) + "$"


def matches_pattern(subject: Column, patterns: str) -> Column:
    """True where the subject matches any pattern of a comma-separated list."""
    out = F.lit(False)
    for pattern in patterns.split(","):
        if pattern.strip():
            out = out | subject.rlike(pattern_to_regex(pattern))
    return F.coalesce(out, F.lit(False))


# The tokens of a target subject that name its folder.
LAYOUT = {1: "company_id", 3: "logical"}


def layout_filter(patterns: str) -> Column:
    """What the patterns say about the folder of a target subject, for partition pruning.

    True for every folder that may hold a match; only folder columns are looked at.
    """
    out = F.lit(False)
    for pattern in patterns.split(","):
        if not pattern.strip():
            continue
        tokens = pattern.strip().split(".")
        may = F.lit(True)
        for place, column in LAYOUT.items():
            open_end = ">" in tokens[-1:] and place >= len(tokens) - 1
            if place < len(tokens) and tokens[place] != "*" and not open_end:
                may = may & (F.col(column) == tokens[place])
        out = out | may
    return out


def subject_filter(df: DataFrame, patterns: str, subject: str = "subject") -> DataFrame:
    return df.filter(matches_pattern(F.col(subject), patterns))


def table_filter(df: DataFrame, tables: Sequence[TableSpec] = DEFAULT_TABLES) -> DataFrame:
    """Keep rows whose subject names a processed table; looks at the subject only."""
    info = F.col("subject_info")
    return df.filter(info["is_valid"] & info["table_name"].isin(table_names(tables)))


def target_subject(table_col: str, tables: Sequence[TableSpec]) -> Column:
    """``websocket.<company>.<agent>.<table>[.<chat>]`` from the routing ids."""

    def build(spec: TableSpec) -> Column:
        parts = [F.lit(TARGET_PREFIX), F.col("company_id"), F.col("agent_id"), F.lit(spec.name)]
        if spec.per_chat:
            parts.append(F.col("chat_id"))
        return F.concat_ws(".", *parts)

    return per_table(table_col, tables, build)
