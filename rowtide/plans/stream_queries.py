"""Streaming operators, run to the end over a captured log in several files."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rowtide.operators import classify as C, events
from rowtide.operators.metrics import label_text
from rowtide.operators.outcomes import outcomes
from rowtide.plans.queries import with_whole
from rowtide.session import materialize, scratch, shared_dir, small_methods
from rowtide.sources import upsert
from rowtide.sources.event_log import cdc_log
from rowtide.sources.logs import LOG_SCHEMA, read_log, stream_log
from rowtide.sources.store import committed
from rowtide.streaming import flow, run
from rowtide.streaming.dedup import check_complete, data_batches_only, dedup_ttl_stream, dedup_watermark
from rowtide.streaming.watch import FailureWatch, RedeliveryWatch, Watch

PARTS = 3
OVERLAP_SECONDS = 200


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """As many state partitions as the session has cores.

    Their number is fixed when a query first starts; each one holds a state
    store and, for the Python state function, a worker.
    """
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def work_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/rowtide/stream-{uuid.uuid4().hex}"


def capture(
    spark: SparkSession, sf_dir: str, path: str, parts: int = PARTS, files: int | None = None, overlap_seconds: int = 0
) -> str:
    """Write the log as files that follow each other in time, ``files`` for each part if given.

    With ``overlap_seconds`` a delivery is captured that much too early or late
    at most, so the parts overlap in time by twice as much. The bodies are built
    once and dealt to their parts from a written table.
    """
    at = F.unix_micros("received_at")
    with scratch(spark):
        with small_methods(spark):
            log = materialize(cdc_log(spark, sf_dir), "deliveries")
        low, high = log.agg(F.min(at), F.max(at)).first()
        width = (high - low) // parts + 1
        if overlap_seconds:
            off = F.pmod(F.xxhash64("stream_seq"), F.lit(2 * overlap_seconds + 1)) - overlap_seconds
            at = F.greatest(F.lit(low), F.least(F.lit(high), at + off * 1_000_000))
        for part in range(parts):
            start = low + part * width
            rows = log.filter(F.coalesce((at >= start) & (at < start + width), F.lit(part == 0)))
            rows = rows if files is None else rows.repartition(files)
            rows.withColumn("part", F.lit(part)).write.mode("append").parquet(path)
    return path


def _captured(spark: SparkSession, sf_dir: str, work: str, overlap_seconds: int = 0) -> tuple[str, int]:
    """The log in parts of a file per core, and how many files are one part.

    A trigger that takes that many reads one part, with all cores.
    """
    files = spark.sparkContext.defaultParallelism
    return capture(spark, sf_dir, f"{work}/log", files=files, overlap_seconds=overlap_seconds), files


def _drain(
    df: DataFrame, work: str, name: str, check: Callable[[StreamingQuery], None] | None = None
) -> DataFrame:
    """Run a stream over everything available and read what it wrote."""
    with state_partitions(df.sparkSession), data_batches_only(df.sparkSession):
        query = (
            df.writeStream.format("parquet")
            .option("path", f"{work}/{name}")
            .option("checkpointLocation", f"{work}/checkpoints/{name}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    if check:
        check(query)
    return df.sparkSession.read.schema(df.schema).parquet(f"{work}/{name}")


def src_stream(spark, sf_dir):
    work = work_dir(spark)
    log, files = _captured(spark, sf_dir, work)
    stream = stream_log(spark, log, max_files=files)
    return _drain(stream, work, "copy").select(
        "stream_seq", "subject", F.unix_micros("received_at").alias("received_us")
    )


def bounded_intake(spark, sf_dir):
    """What each trigger took in: two files, which are one part of the log."""
    work = work_dir(spark)
    log = capture(spark, sf_dir, f"{work}/log", files=2)

    def keep(batch: DataFrame, number: int) -> None:
        batch.select("stream_seq").write.mode("overwrite").parquet(f"{work}/taken/batch={number}")

    query = (
        stream_log(spark, log, max_files=2)
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", f"{work}/checkpoints/taken")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    taken = spark.read.parquet(f"{work}/taken")
    return taken.groupBy(F.col("batch").cast("bigint").alias("batch")).agg(
        F.count("*").alias("n"), F.min("stream_seq").alias("first_seq")
    )


def _keyed_stream(spark, sf_dir, work, overlap_seconds: int = 0) -> DataFrame:
    log, files = _captured(spark, sf_dir, work, overlap_seconds)
    stream = stream_log(spark, log, max_files=files)
    routable = C.classify(stream).filter(F.col("result").isNull() & F.col("sink_ok") & F.col("dedup_ok"))
    return routable.select("event_id", "received_at", "stream_seq")


def dedup_ttl_streamed(spark, sf_dir):
    """Accepted deliveries of a log whose files overlap in time: the labels of one batch."""
    work = work_dir(spark)
    flow.dedup_stream(_keyed_stream(spark, sf_dir, work, OVERLAP_SECONDS), work, delay_seconds=2 * OVERLAP_SECONDS)
    return committed(spark, work, "flagged").filter("dedup = 'miss'").select(
        "event_id", F.unix_micros("received_at").alias("received_us"), "stream_seq"
    )


def dedup_state_streamed(spark, sf_dir):
    """The same rule with the windows in Spark's own state store, on files in order."""
    work = work_dir(spark)
    flagged = dedup_ttl_stream(_keyed_stream(spark, sf_dir, work))
    return _drain(flagged.filter("dedup = 'miss'"), work, "accepted").select(
        "event_id", F.unix_micros("received_at").alias("received_us"), "stream_seq"
    )


def dedup_continued(spark, sf_dir):
    """Three runs over a third of the log each; a run reads its own log and the windows near it."""
    work = work_dir(spark)
    capture(spark, sf_dir, f"{work}/log")
    for part in range(PARTS):
        log = read_log(spark, f"{work}/log", schema=f"{LOG_SCHEMA}, part int").filter(F.col("part") == part)
        routable = C.classify(log).filter(F.col("result").isNull() & F.col("sink_ok") & F.col("dedup_ok"))
        flow.dedup_run(routable.select("event_id", "received_at", "stream_seq"), work, part)
    return committed(spark, work, "flagged").filter("dedup = 'miss'").select(
        "event_id", F.unix_micros("received_at").alias("received_us"), "stream_seq"
    )


def dedup_watermark_streamed(spark, sf_dir):
    """Event ids that survive the approximate rule: every one of them, at least once."""
    work = work_dir(spark)
    kept = _drain(dedup_watermark(_keyed_stream(spark, sf_dir, work)), work, "kept", check_complete)
    return kept.select("event_id").distinct()


def _settled(spark, sf_dir) -> str:
    work = work_dir(spark)
    log, files = _captured(spark, sf_dir, work, OVERLAP_SECONDS)
    run.settle_log(
        spark, log, work, max_files=files, stamp=F.col("received_at"), delay_seconds=2 * OVERLAP_SECONDS
    )
    return work


def streamed_outcomes(spark, sf_dir):
    work = _settled(spark, sf_dir)
    return spark.read.parquet(f"{work}/outcomes").select(
        "stream_seq",
        F.unix_micros("received_at").alias("received_us"),
        "consumer_id",
        "subject_table",
        "payload_table",
        "event_id",
        "target_subject",
        "result",
        "result_table",
        "error_code",
        "disposition",
        "dedup",
        F.array_join("unhandled_fields", ",").alias("unhandled_fields"),
    )


def sink_routed(spark, sf_dir):
    work = _settled(spark, sf_dir)
    run.route_events(spark, work)
    schema = "event_id string, target_subject string, payload string, stream_seq bigint, company_id string, logical string"
    return spark.read.schema(schema).json(f"{work}/published").select(
        "event_id",
        "stream_seq",
        "company_id",
        "logical",
        "target_subject",
        F.get_json_object("payload", "$.event_time").alias("event_time"),
    )


def quarantine_streamed(spark, sf_dir):
    work = _settled(spark, sf_dir)
    run.keep_rejected(spark, work)
    return with_whole(spark.read.parquet(f"{work}/quarantine"), cdc_log(spark, sf_dir))


def streamed_metrics(spark, sf_dir):
    work = _settled(spark, sf_dir)
    run.count_outcomes(spark, work)
    snapshot = run.metrics_snapshot(spark, work)
    return snapshot.select("metric", label_text(F.col("labels")).alias("labels"), "value")


def pipeline_streamed(spark, sf_dir):
    """What one pass over a log with overlapping files leaves in every sink, in one table."""
    work = work_dir(spark)
    log, files = _captured(spark, sf_dir, work, OVERLAP_SECONDS)
    flow.pipeline_stream(
        spark, log, work, max_files=files, stamp=F.col("received_at"), delay_seconds=2 * OVERLAP_SECONDS
    )
    flow.fold_metrics(spark, work)
    sent = upsert.latest_events(spark, f"{work}/events").select(
        F.lit("events").alias("sink"), F.col("event_id").alias("id"), F.col("stream_seq").cast("double").alias("value")
    )
    refused = committed(spark, work, "quarantine").groupBy("error_code").agg(F.count("*").cast("double").alias("value"))
    counted = flow.metrics_snapshot(spark, work)
    name = F.concat_ws("|", "metric", label_text(F.col("labels")))
    return sent.unionByName(
        refused.select(F.lit("quarantine").alias("sink"), F.col("error_code").alias("id"), "value")
    ).unionByName(counted.select(F.lit("metrics").alias("sink"), name.alias("id"), "value"))


def lag_gauge(spark, sf_dir):
    """The lag of each consumer as the last micro-batch left it."""
    work = work_dir(spark)
    log, files = _captured(spark, sf_dir, work)
    flow.pipeline_stream(spark, log, work, max_files=files, stamp=F.col("received_at"), sinks=("metrics",))
    return flow.lag_gauge(spark, work)


def _watched(spark, sf_dir, make: Callable[[str], Watch]) -> Watch:
    """A watch over the outcomes of a log whose files overlap in time."""
    work = work_dir(spark)
    log, files = _captured(spark, sf_dir, work, OVERLAP_SECONDS)
    watch = make(work)
    flow.pipeline_stream(
        spark,
        log,
        work,
        max_files=files,
        stamp=F.col("received_at"),
        delay_seconds=2 * OVERLAP_SECONDS,
        sinks=(),
        watches=[watch],
    )
    return watch


def failure_guard_stream(spark, sf_dir):
    watch = _watched(spark, sf_dir, lambda work: FailureWatch(spark, work, delay_seconds=600))
    return watch.runs(threshold_seconds=60).select(
        "consumer_id",
        F.unix_micros("first_failure").alias("first_us"),
        F.unix_micros("last_failure").alias("last_us"),
        "failures",
        "breached",
    )


def redelivery_timers(spark, sf_dir):
    number = "CAST(floor(stream_seq / 10) AS BIGINT)"
    watch = _watched(spark, sf_dir, lambda work: RedeliveryWatch(spark, work, 2 * OVERLAP_SECONDS, message=number))
    return watch.found().select("message", "attempts", "status", F.unix_micros("due_at").alias("due_us"))


def upsert_events(spark, sf_dir):
    """The last publication of every event after four batches, one of them written twice, and a compaction between."""
    path = f"{work_dir(spark)}/events"
    published = events.published(outcomes(cdc_log(spark, sf_dir)), stamp="received_at")
    published = materialize(published.drop("row_data"), "published")
    for number in (0, 1, 1, 2, 3):
        upsert.upsert_batch(published.filter(F.col("stream_seq") % 4 == number), path, number)
        if number == 2:
            upsert.compact(spark, path)
    return upsert.latest_events(spark, path).select("event_id", "stream_seq", "company_id", "logical", "target_subject")


STREAM_QUERIES = {
    "src_stream": src_stream,
    "bounded_intake": bounded_intake,
    "dedup_ttl_stream": dedup_ttl_streamed,
    "dedup_state_stream": dedup_state_streamed,
    "dedup_continued": dedup_continued,
    "dedup_watermark": dedup_watermark_streamed,
    "streamed_outcomes": streamed_outcomes,
    "sink_routed": sink_routed,
    "quarantine_stream": quarantine_streamed,
    "streamed_metrics": streamed_metrics,
    "pipeline_stream": pipeline_streamed,
    "lag_gauge": lag_gauge,
    "upsert_events": upsert_events,
    "failure_guard_stream": failure_guard_stream,
    "redelivery_timers": redelivery_timers,
}
