"""Headline timings; prints one JSON line.

The change log is derived from ``events`` and captured as Parquet first, outside
the timings, as a consumer would find it. Every query then runs over the whole
log into Spark's ``noop`` sink, after one warm-up pass on the same session; the
better of two runs counts. ``settle_log`` is one run of the streaming flow over the
captured files, ``dedup_hot_key`` deduplicates a log of which one key has a third,
``classify_x10`` classifies ten copies of the log. ``rates`` gives deliveries per
second end to end by payload size and share of duplicates.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.operators import classify as C, dedup as D, events as E, metrics as M, reliability as G
from rowtide.operators.outcomes import outcomes
from rowtide.session import configure, materialize, shared_dir, tune
from rowtide.sources.event_log import cdc_log
from rowtide.streaming import run

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("rowtide-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    folder = os.environ.get("SPARK_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="rowtide-bench-")
    builder = builder.config("spark.checkpoint.dir", folder)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(configure(spark))


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(build) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        noop(build())
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def streamed(log: DataFrame) -> float:
    """Seconds that the streaming flow takes for the whole log, from files to outcomes."""
    work = f"{shared_dir(log.sparkSession)}/bench-stream-{time.time_ns()}"
    log.write.parquet(f"{work}/log")
    start = time.perf_counter()
    run.settle_log(log.sparkSession, f"{work}/log", work)
    return round(time.perf_counter() - start, 3)


def payload_log(spark: SparkSession, size: str, duplicate_share: int) -> DataFrame:
    """Messages with bodies from ``conversations``, a share of them delivered twice."""
    talk = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    n = F.concat_ws("-", F.col("conv_id"), F.col("turn"))
    text = {
        "small": F.substring("text", 1, 20),
        "medium": F.substring("text", 1, 200),
        "large": F.col("text"),
    }[size]
    record = [
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.concat(F.lit("msg-"), n).alias("message_id"),
        F.concat(F.lit("chat-"), F.col("conv_id")).alias("chat_id"),
        F.concat(F.lit("agent-"), F.col("conv_id") % 97).alias("agent_id"),
        F.concat(F.lit("company-"), F.col("conv_id") % 11).alias("company_id"),
        F.struct(text.alias("text")).alias("message_obj"),
    ]
    if size != "small":
        record += [
            F.col("role").alias("flow"),
            F.lit("delivered").alias("status"),
            F.lit(False).alias("is_deleted"),
            F.lit("2024-01-01").alias("message_date"),
            F.lit("2024-01-01T00:00:00Z").alias("created_at"),
        ]
    meta = F.struct(
        F.lit("public").alias("table_schema"),
        F.lit("messages").alias("table_name"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("commit_lsn"),
    )
    body = F.to_json(
        F.struct(F.struct(*record).alias("record"), F.lit("insert").alias("action"), meta.alias("metadata"))
    )
    again = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(100)) < duplicate_share
    copies = F.explode(F.when(again, F.array(F.lit(0), F.lit(30))).otherwise(F.array(F.lit(0))))
    start = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("conv_id") * 10 + F.col("turn"))
    return talk.withColumn("offset_s", copies).select(
        F.lit("sequin.changes.appdb.public.messages.insert").alias("subject"),
        body.alias("data"),
        (F.col("conv_id") * 100_000 + F.col("turn") * 100 + F.col("offset_s")).alias("stream_seq"),
        (start + F.make_dt_interval(secs=F.col("offset_s"))).alias("received_at"),
    )


def main() -> None:
    spark = session()
    log = materialize(cdc_log(spark, SF_DIR).repartition(int(CPUS)), "bench-log")
    rows = log.count()
    noop(E.published(outcomes(log), "received_at"))

    settled = materialize(outcomes(log), "bench-outcomes")
    keys = settled.filter("event_id IS NOT NULL").select("event_id", "received_at", "stream_seq")
    queries = {
        "classify": best(lambda: C.classify(log)),
        "published_events": best(lambda: E.published(outcomes(log), "received_at")),
        "outcomes": best(lambda: outcomes(log)),
        "dedup_ttl": best(lambda: D.accepted_deliveries(keys)),
        "metrics_snapshot": best(lambda: M.metrics_snapshot(settled)),
        "failure_guard": best(lambda: G.failure_guard(settled)),
        "slo_report": best(lambda: M.slo_report(settled)),
        "settle_log": streamed(log),
    }
    hot = keys.withColumn("event_id", F.when(F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0, "hot").otherwise(F.col("event_id")))
    queries["dedup_hot_key"] = best(lambda: D.accepted_deliveries(hot))
    tenfold = materialize(log.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(10)))).drop("copy"), "bench-log-x10")
    queries["classify_x10"] = best(lambda: C.classify(tenfold))
    rates = {}
    for size in ("small", "medium", "large"):
        for share in (0, 10, 50):
            talk = materialize(payload_log(spark, size, share).repartition(int(CPUS)), "bench-talk")
            seconds = best(lambda: E.published(outcomes(talk), "received_at"))
            rates[f"{size}_dup{share}"] = round(talk.count() / seconds)
    total = round(sum(queries.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": queries,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
                "deliveries": rows,
                "events_per_second": {
                    "classify": round(rows / queries["classify"]),
                    "published_events": round(rows / queries["published_events"]),
                },
                "rates": rates,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
