"""The whole flow as one streaming query.

Each micro-batch is classified and written once, deduplicated against the
windows of earlier ones by the batch rule, and fanned out from the written
outcomes to the event table, the quarantine and the counters. Everything is
columns and joins; no state lives in a worker. A batch is committed by number in
one log for all sinks, see :mod:`rowtide.sources.store`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rowtide.functions.records import format_rfc3339, payload_json
from rowtide.operators import classify as C, metrics as M
from rowtide.operators.dedup import DEFAULT_TTL_SECONDS, flag_deliveries
from rowtide.operators.outcomes import ROW, flag_staged, settle, with_health
from rowtide.schemas import DEFAULT_TABLES, TableSpec
from rowtide.session import materialize, remove, scratch
from rowtide.sources import upsert
from rowtide.sources.logs import stream_log
from rowtide.sources.store import BatchLog, WindowStore, committed, names, write_batch
from rowtide.streaming.watch import Watch

KEEP_SECONDS = 86_400
REFUSED = (C.SUBJECT_ERROR, C.UNMARSHAL_ERROR, C.DATA_ERROR)
SINKS = ("events", "quarantine", "metrics")
_SECOND = 1_000_000


class Settler:
    """Labels micro-batches one after the other, whatever order their arrivals come in.

    The windows of a key are a set of disjoint intervals. An arrival in a known
    window is a duplicate, also one of an earlier time than the last batch; so is
    one less than a ttl before a known window, since its event went out already.
    All others follow the batch rule among themselves.

    With ``delay_seconds`` an arrival waits until one that much later has been
    seen (or until ``flush``), so batches that overlap in time by less than that
    get exactly the labels of one batch. Windows are forgotten ``keep_seconds``
    after the latest arrival.
    """

    def __init__(self, spark: SparkSession, out_dir: str, ttl_seconds: int, delay_seconds: int, keep_seconds: int):
        if keep_seconds < ttl_seconds or delay_seconds < 0:
            raise ValueError("keep_seconds must be at least ttl_seconds, delay_seconds not negative")
        self.spark, self.out_dir, self.ttl = spark, out_dir, ttl_seconds
        self.delay, self.keep = delay_seconds * _SECOND, keep_seconds * _SECOND
        self.log = BatchLog(spark, f"{out_dir}/commits")
        self.windows = WindowStore(spark, f"{out_dir}/windows")

    def waiting(self, facts: dict) -> DataFrame | None:
        folder = f"{self.out_dir}/waiting/batch={facts.get('waiting')}"
        return self.spark.read.parquet(folder) if facts.get("waiting") is not None else None

    def run(
        self,
        rows: DataFrame | None,
        number: int,
        label: Callable[[DataFrame, DataFrame | None], DataFrame],
        fan_out: Callable[[DataFrame, int], None] | None = None,
        name: str = "outcomes",
        can_wait: Column | None = None,
        flush: bool = False,
    ) -> None:
        """Label the rows of batch ``number`` with those that waited, write them, feed the sinks, commit."""
        last, facts = self.log.last()
        if number <= last:
            return
        with scratch(self.spark):
            held = self.waiting(facts)
            both = held if rows is None else rows if held is None else rows.unionByName(held)
            if both is None:
                return
            staged = materialize(both.withColumn(ROW, F.monotonically_increasing_id()), "staged")
            at = F.unix_micros("received_at")
            waits = F.lit(True) if can_wait is None else can_wait
            low, high, newest = staged.agg(F.min(F.when(waits, at)), F.max(F.when(waits, at)), F.max(at)).first()
            seen = max((t for t in (newest, facts.get("seen")) if t is not None), default=None)
            ripe, still = staged, None
            if self.delay and not flush and seen is not None:
                late = F.coalesce(waits & (at > seen - self.delay), F.lit(False))
                ripe, still = staged.filter(~late), staged.filter(late).drop(ROW)
            windows = self.windows.near(low, high, number, self.ttl)
            write_batch(label(ripe, windows), f"{self.out_dir}/{name}", number)
            done = self.spark.read.parquet(f"{self.out_dir}/{name}/batch={number}")
            opened = done.filter("dedup = 'miss'")
            self.windows.add(opened.filter("sink_ok") if "sink_ok" in done.columns else opened, number, low, high)
            if still is not None:
                write_batch(still, f"{self.out_dir}/waiting", number)
            if fan_out:
                fan_out(done, number)
            self.log.commit(number, {"seen": seen, "waiting": None if still is None else number})
            if facts.get("waiting") is not None:
                remove(self.spark, f"{self.out_dir}/waiting/batch={facts['waiting']}")
            if seen is not None:
                self.windows.expire(seen - self.keep)

    def finish(self, label, fan_out=None, name: str = "outcomes") -> None:
        """Label what still waits. Odd numbers are kept free for that between the batches of the stream."""
        last, facts = self.log.last()
        if facts.get("waiting") is not None:
            self.run(None, last + 1, label, fan_out, name, flush=True)


def _drain(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    query = (
        stream.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def dedup_stream(
    events: DataFrame,
    out_dir: str,
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
    delay_seconds: int = 0,
    keep_seconds: int = KEEP_SECONDS,
) -> StreamingQuery:
    """Label a stream of ``event_id, received_at, stream_seq`` with ``dedup`` into ``flagged``, up to its end."""
    settler = Settler(events.sparkSession, out_dir, ttl_seconds, delay_seconds, keep_seconds)

    def label(rows: DataFrame, windows: DataFrame | None) -> DataFrame:
        return flag_deliveries(rows, ttl_seconds, windows=windows, row=ROW).drop(ROW)

    query = _drain(
        events, f"{out_dir}/checkpoints/flagged", lambda rows, k: settler.run(rows, 2 * k, label, name="flagged")
    )
    settler.finish(label, name="flagged")
    return query


def dedup_run(
    deliveries: DataFrame,
    out_dir: str,
    number: int,
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
    keep_seconds: int = KEEP_SECONDS,
) -> None:
    """Label one log of ``event_id, received_at, stream_seq`` as the next part of those before it.

    Writes ``flagged``; of earlier runs only the windows near this log's times
    are read. A run of a number that is done changes nothing.
    """

    def label(rows: DataFrame, windows: DataFrame | None) -> DataFrame:
        return flag_deliveries(rows, ttl_seconds, windows=windows, row=ROW).drop(ROW)

    Settler(deliveries.sparkSession, out_dir, ttl_seconds, 0, keep_seconds).run(deliveries, number, label, name="flagged")


def _fan_out(out_dir: str, sinks: Sequence[str]) -> Callable[[DataFrame, int], None]:
    def fan_out(done: DataFrame, number: int) -> None:
        if "events" in sinks:
            sent = done.filter(F.col("result") == C.PROCESSED).withColumn("logical", F.col("payload_table"))
            upsert.upsert_batch(sent, f"{out_dir}/events", number)
        if "quarantine" in sinks:
            kept = ("stream_seq", "received_at", "subject", "result", "error_code", "error_stage", "body", "preview")
            write_batch(done.filter(F.col("result").isin(*REFUSED)).select(*kept), f"{out_dir}/quarantine", number)
        if "metrics" in sinks:
            for name, count in M.PARTS.items():
                write_batch(count(done), f"{out_dir}/metrics/{name}", number)

    return fan_out


def pipeline_stream(
    spark: SparkSession,
    source: str,
    out_dir: str,
    tables: Sequence[TableSpec] = DEFAULT_TABLES,
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
    delay_seconds: int = 0,
    keep_seconds: int = KEEP_SECONDS,
    stamp: Column | None = None,
    max_files: int = 100,
    sinks: Sequence[str] = SINKS,
    watches: Sequence[Watch] = (),
) -> StreamingQuery:
    """Bring all tables of ``out_dir`` up to date with the log and stop.

    Reads each file of the log once. Writes ``outcomes``, ``events`` (see
    :func:`rowtide.sources.upsert.latest_events`), ``quarantine`` and
    ``metrics``; read the others through
    :func:`rowtide.sources.store.committed`. ``watches`` take in the outcomes of
    every batch, and with ``delay_seconds`` or the end of the run what waits.
    """
    settler = Settler(spark, out_dir, ttl_seconds, delay_seconds, keep_seconds)
    at = F.current_timestamp() if stamp is None else stamp
    routable = F.col("result").isNull()
    to_sinks = _fan_out(out_dir, sinks)

    def fan_out(done: DataFrame, number: int) -> None:
        to_sinks(done, number)
        for watch in watches:
            watch.step(done, 2 * number)

    def label(rows: DataFrame, windows: DataFrame | None) -> DataFrame:
        return settle(flag_staged(rows, ttl_seconds, windows))

    def batch(raw: DataFrame, number: int) -> None:
        rows = with_health(C.classify(raw, tables)).withColumn("event_time", format_rfc3339(at))
        rows = rows.withColumn("payload", F.when(routable, payload_json(F.col("event_time")))).drop("record")
        settler.run(rows, 2 * number, label, fan_out, can_wait=routable)

    query = _drain(stream_log(spark, source, max_files=max_files), f"{out_dir}/checkpoints/outcomes", batch)
    settler.finish(label, fan_out)
    for watch in watches:
        watch.flush()
    return query


def _metric_parts(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """Counter parts of committed batches, those up to the last fold as one."""
    parts = committed(spark, out_dir, f"metrics/{name}")
    base, _ = BatchLog(spark, f"{out_dir}/folds").last()
    if base < 0:
        return parts
    folded = spark.read.parquet(f"{out_dir}/folded/{base}/{name}").withColumn("batch", F.lit(base))
    return parts.filter(F.col("batch") > base).unionByName(folded)


def metrics_snapshot(spark: SparkSession, out_dir: str) -> DataFrame:
    """All metrics as counted by the committed batches of :func:`pipeline_stream`."""
    return M.snapshot_of(*[_metric_parts(spark, out_dir, n) for n in ("summary", "published", "drift")])


def fold_metrics(spark: SparkSession, out_dir: str) -> None:
    """Fold the counter parts of all committed batches into one, so that snapshots read few files.

    The fold counts once its own log names it; a fold that broke off leaves the
    parts as they were. To be called between runs of the stream.
    """
    last, _ = BatchLog(spark, f"{out_dir}/commits").last()
    folds = BatchLog(spark, f"{out_dir}/folds")
    before, _ = folds.last()
    if last <= before:
        return
    for name, fold in M.FOLDS.items():
        fold(_metric_parts(spark, out_dir, name)).write.mode("overwrite").parquet(f"{out_dir}/folded/{last}/{name}")
    folds.commit(last, {})
    remove(spark, f"{out_dir}/folded/{before}")
    for name in M.FOLDS:
        for folder in names(spark, f"{out_dir}/metrics/{name}"):
            if folder.startswith("batch=") and int(folder.removeprefix("batch=")) < last:
                remove(spark, f"{out_dir}/metrics/{name}/{folder}")


def lag_gauge(spark: SparkSession, out_dir: str) -> DataFrame:
    """``consumer_id, lag_seconds``: the lag of each consumer in the last batch that had an acknowledgement of it."""
    return M.last_lag(_metric_parts(spark, out_dir, "lag"))
