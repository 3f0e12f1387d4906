"""Published events with one row per event id.

Batches append what they publish, laid out by company and table, each batch in
folders of its own that a second run replaces. Readers take the last delivery of
every event id. ``compact`` folds what is there into a base table by bucket of
the id; the manifest says which base and which batches make up the table, and is
replaced in one step, so a reader never sees half of a compaction.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.session import remove
from rowtide.sources.store import exists, names, read_text, write_batch, write_text

COLUMNS = "event_id string, stream_seq bigint, received_at timestamp, target_subject string, payload string"
LAYOUT = "company_id string, logical string"
BUCKETS = 64


def manifest(spark: SparkSession, path: str) -> dict:
    """``base`` (a folder or null) and ``batches`` that the table consists of."""
    file = f"{path}/manifest.json"
    return json.loads(read_text(spark, file)) if exists(spark, file) else {"base": None, "upto": -1, "batches": []}


def upsert_batch(events: DataFrame, path: str, number: int) -> None:
    """Put the events of a batch into the table; the same batch again changes nothing.

    Rows are brought together by folder in partitions of even size, so a hot
    company is written by several tasks and small folders get one file.
    """
    spark = events.sparkSession
    now = manifest(spark, path)
    if number <= now["upto"]:
        return
    chosen = events.select(*[n.split()[0] for n in f"{COLUMNS}, {LAYOUT}".split(", ")])
    write_batch(chosen.hint("rebalance", "company_id", "logical"), f"{path}/delta", number, by=("company_id", "logical"))
    if number not in now["batches"]:
        now["batches"] = sorted([*now["batches"], number])
        write_text(spark, f"{path}/manifest.json", json.dumps(now))


def _parts(spark: SparkSession, path: str, now: dict) -> DataFrame:
    schema = f"{COLUMNS}, {LAYOUT}"
    parts = [spark.read.schema(schema).parquet(f"{path}/delta/batch={n}") for n in now["batches"]]
    if now["base"]:
        parts.append(spark.read.schema(f"{schema}, bucket int").parquet(f"{path}/{now['base']}").drop("bucket"))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def latest_events(spark: SparkSession, path: str) -> DataFrame:
    """One row per event id: its last published delivery, by arrival and number."""
    rows = _parts(spark, path, manifest(spark, path))
    rest = [c for c in rows.columns if c != "event_id"]
    last = F.max_by(F.struct(*rest), F.struct("received_at", "stream_seq")).alias("last")
    return rows.groupBy("event_id").agg(last).select("event_id", "last.*")


def compact(spark: SparkSession, path: str) -> None:
    """Fold all batches into a new base and delete what it replaces.

    A reader that has the old manifest open during the deletion fails and reads
    again; one that starts later sees the new base.
    """
    before = manifest(spark, path)
    if not before["batches"]:
        return
    upto = before["batches"][-1]
    base = f"base-{upto}"
    bucket = F.pmod(F.xxhash64("event_id"), F.lit(BUCKETS)).cast("int")
    rows = latest_events(spark, path).withColumn("bucket", bucket)
    rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{base}")
    write_text(spark, f"{path}/manifest.json", json.dumps({"base": base, "upto": upto, "batches": []}))
    for name in names(spark, f"{path}/delta"):
        if int(name.removeprefix("batch=")) <= upto:
            remove(spark, f"{path}/delta/{name}")
    if before["base"] and before["base"] != base:
        remove(spark, f"{path}/{before['base']}")
