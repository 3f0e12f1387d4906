"""One terminal outcome per delivery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowtide.operators import classify as C
from rowtide.operators.dedup import DEFAULT_TTL_SECONDS, flag_deliveries
from rowtide.schemas import DEFAULT_TABLES, TableSpec
from rowtide.session import materialize

RETRIED = (C.DEDUP_ERROR, C.PUBLISH_ERROR, C.SYSTEM_ERROR)


def terminal_result() -> Column:
    """The result after deduplication and publishing, first match wins."""
    return (
        F.when(F.col("result").isNotNull(), F.col("result"))
        .when(~F.col("dedup_ok"), C.DEDUP_ERROR)
        .when(F.col("dedup") == "hit", C.DUPLICATE)
        .when(~F.col("sink_ok"), C.PUBLISH_ERROR)
        .otherwise(C.PROCESSED)
    )


def disposition(result: Column) -> Column:
    """System failures are handed back for another delivery, the rest is done."""
    return F.when(result.isin(*RETRIED), "nack").otherwise("ack")


def settle(flagged: DataFrame) -> DataFrame:
    """Set ``result`` and ``disposition`` on classified rows that carry ``dedup``."""
    return flagged.withColumn("result", terminal_result()).withColumn(
        "disposition", disposition(F.col("result"))
    )


def with_health(classified: DataFrame) -> DataFrame:
    """Make sure ``sink_ok`` and ``dedup_ok`` exist; both default to true.

    They say whether publishing, and the lookup of the event id, worked for a
    delivery, so that the failure branches can be replayed from a log.
    """
    out = classified
    for name in ("sink_ok", "dedup_ok"):
        known = F.coalesce(F.col(name), F.lit(True)) if name in classified.columns else F.lit(True)
        out = out.withColumn(name, known)
    return out


KEYS = ("event_id", "received_at", "stream_seq", "sink_ok", "dedup_ok", "result")
ROW = "_row"


def outcomes(
    raw: DataFrame,
    tables: Sequence[TableSpec] = DEFAULT_TABLES,
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
    columns: Sequence[str] | None = None,
    windows: DataFrame | None = None,
) -> DataFrame:
    """Classify, deduplicate and settle every delivery of a captured log.

    Exactly one row per input row. The classified rows are written to the shared
    folder once, so the JSON is decoded once; deduplication reads only keys and
    row numbers of them. ``columns`` names what the caller wants of the result:
    other columns of the classification are neither computed nor written.
    ``windows`` are deliveries accepted in earlier logs.
    """
    classified = with_health(C.classify(raw, tables))
    if columns is not None:
        wanted = [n for n in classified.columns if n in columns or n in KEYS]
        classified = classified.select(*wanted)
    staged = materialize(classified.withColumn(ROW, F.monotonically_increasing_id()), "classified")
    settled = settle(flag_staged(staged, ttl_seconds, windows))
    return settled if columns is None else settled.select(*columns)


def flag_staged(staged: DataFrame, ttl_seconds: int = DEFAULT_TTL_SECONDS, windows: DataFrame | None = None) -> DataFrame:
    """Add ``dedup`` to a written table of classified rows with numbers in ``ROW``, which goes."""
    # A delivery whose lookup failed never reaches the window state.
    looked_up = staged.withColumn("event_key", F.when(F.col("dedup_ok"), F.col("event_id")))
    windows = windows if windows is None else windows.withColumnRenamed("event_id", "event_key")
    flagged = flag_deliveries(
        looked_up, ttl_seconds, key="event_key", published="sink_ok", windows=windows, row=ROW
    )
    return flagged.drop("event_key", ROW)
