"""Watches over outcome batches: runs of failures and redelivery timers.

A watch keeps a small table from batch to batch, one row per consumer or open
message, and writes what it finds. Rows wait until an event ``delay_seconds``
later has been seen, so batches may overlap in time by that much; the time seen
so far is the clock, and advances with any consumer's or message's events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rowtide.operators import classify as C, reliability as G
from rowtide.operators.outcomes import RETRIED
from rowtide.session import materialize, remove, scratch
from rowtide.sources.store import BatchLog, write_batch

_SECOND = 1_000_000


class Watch:
    """What all watches share: waiting rows, the carried table, the log of batches."""

    name: str
    at: str
    found_schema: str

    def __init__(self, spark: SparkSession, out_dir: str, delay_seconds: int = 0):
        self.spark, self.dir, self.delay = spark, f"{out_dir}/{self.name}", delay_seconds * _SECOND
        self.log = BatchLog(spark, f"{self.dir}/commits")

    def chosen(self, done: DataFrame) -> DataFrame:
        raise NotImplementedError

    def advance(self, ripe: DataFrame, carried: DataFrame | None, clock: int | None) -> tuple[DataFrame, DataFrame]:
        """What is found in ``ripe`` rows up to ``clock`` (None: the end), and the table to carry on."""
        raise NotImplementedError

    def _kept(self, facts: dict, table: str) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.dir}/{table}/batch={facts['number']}") if facts else None

    def step(self, done: DataFrame | None, number: int, flush: bool = False) -> None:
        """Take in the outcomes of a batch; a number that is done changes nothing."""
        last, facts = self.log.last()
        if number <= last or (done is None and not facts):
            return
        with scratch(self.spark):
            held = self._kept(facts, "waiting")
            rows = None if done is None else self.chosen(done)
            rows = held if rows is None else rows if held is None else rows.unionByName(held)
            staged = materialize(rows, self.name)
            at = F.unix_micros(self.at)
            newest = staged.agg(F.max(at)).first()[0]
            seen = max((t for t in (newest, facts.get("seen")) if t is not None), default=None)
            clock = None if flush or seen is None else seen - self.delay
            late = F.lit(False) if clock is None else F.coalesce(at > clock, F.lit(False))
            found, carried = self.advance(staged.filter(~late), self._kept(facts, "carried"), clock)
            write_batch(found, f"{self.dir}/found", number)
            write_batch(carried, f"{self.dir}/carried", number)
            write_batch(staged.filter(late), f"{self.dir}/waiting", number)
        self.log.commit(number, {"number": number, "seen": seen})
        if facts:
            for table in ("carried", "waiting"):
                remove(self.spark, f"{self.dir}/{table}/batch={facts['number']}")

    def flush(self) -> None:
        """Take in what still waits, as at the end of the log."""
        self.step(None, self.log.last()[0] + 1, flush=True)

    def found(self) -> DataFrame:
        last, _ = self.log.last()
        return self.spark.read.parquet(f"{self.dir}/found").filter(F.col("batch") <= last).drop("batch")


class FailureWatch(Watch):
    """Runs of system failures per consumer, as :func:`rowtide.operators.reliability.failure_guard` finds them.

    The open run of each consumer is carried; a processed event ends it. A batch's
    failures before its first processed event belong to it.
    """

    name, at = "failures", "acked_at"

    def chosen(self, done: DataFrame) -> DataFrame:
        rows = done.filter((F.col("result") == C.PROCESSED) | F.col("result").isin(*RETRIED))
        return rows.select("consumer_id", "acked_at", "stream_seq", "result")

    def advance(self, ripe, carried, clock):
        key = F.struct("consumer_id").alias("c")  # null is a consumer too
        ends = ("first_failure", "last_failure", "failures")
        runs = G.failure_runs(ripe).select(key, "since", *ends)
        position = F.struct(F.unix_micros("acked_at").alias("at"), F.col("stream_seq").alias("seq"))
        done = F.col("result") == C.PROCESSED
        resets = ripe.groupBy(key).agg(F.max(F.when(done, position)).alias("reset"))
        first = runs.filter(F.col("since").isNull()).drop("since")
        if carried is not None:
            old = carried.select(key, *[F.col(n).alias(f"old_{n}") for n in ends])
            first = first.join(old, "c", "full").select(
                "c",
                F.coalesce("old_first_failure", "first_failure").alias("first_failure"),
                F.coalesce("last_failure", "old_last_failure").alias("last_failure"),
                (F.coalesce("failures", F.lit(0)) + F.coalesce("old_failures", F.lit(0))).alias("failures"),
            )
        none = F.lit(None).cast(runs.schema["since"].dataType)
        both = first.withColumn("since", none).unionByName(runs.filter(F.col("since").isNotNull()), allowMissingColumns=True)
        judged = both.join(resets, "c", "left").select("c.consumer_id", *ends, F.col("since").eqNullSafe(F.col("reset")).alias("open"))
        judged = materialize(judged, "failure-runs")
        return judged.filter("NOT open").drop("open"), judged.filter("open").drop("open")

    def runs(self, threshold_seconds: int = G.GUARD_THRESHOLD_SECONDS) -> DataFrame:
        """Ended and open runs so far, ``breached`` where one lasted longer than the threshold."""
        _, facts = self.log.last()
        elapsed = F.unix_micros("last_failure") - F.unix_micros("first_failure")
        every = self.found().unionByName(self._kept(facts, "carried"))
        return every.withColumn("breached", elapsed > threshold_seconds * _SECOND)


class RedeliveryWatch(Watch):
    """Timers of deliveries without a positive answer.

    A delivery of a message that was not acknowledged by it or an earlier one is
    ``due`` again ``ack_wait_seconds`` later, or ``exhausted`` at the
    ``max_deliver``-th, unless a new delivery came first. The timer goes off when
    the clock passes it, whichever message moved the clock. A message is
    forgotten ``keep_seconds`` after its last delivery. Deliveries without time
    have no timer.
    """

    name, at = "redelivery", "received_at"

    def __init__(
        self,
        spark: SparkSession,
        out_dir: str,
        delay_seconds: int = 0,
        message: str = "message",
        ack_wait_seconds: int = G.ACK_WAIT_SECONDS,
        max_deliver: int = G.MAX_DELIVER,
        keep_seconds: int = 86_400,
    ):
        super().__init__(spark, out_dir, delay_seconds)
        self.message, self.wait, self.most, self.keep = message, ack_wait_seconds * _SECOND, max_deliver, keep_seconds * _SECOND

    def chosen(self, done: DataFrame) -> DataFrame:
        return done.filter(F.col("received_at").isNotNull()).select(
            F.expr(self.message).alias("message"), "received_at", F.col("stream_seq").cast("bigint").alias("stream_seq"), "disposition"
        )

    def advance(self, ripe, carried, clock):
        now = ripe.select(
            "message",
            "received_at",
            "stream_seq",
            F.lit(1).cast("bigint").alias("attempts"),
            F.coalesce(F.col("disposition") == "ack", F.lit(False)).alias("acked"),
            F.lit(False).alias("fired"),
        )
        rows = now if carried is None else now.unionByName(carried)
        # Deliveries of one message; the broker bounds their number.
        order = Window.partitionBy("message").orderBy("received_at", "stream_seq", F.col("attempts").desc())
        upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumns(
            {
                "attempts": F.sum("attempts").over(upto),
                "acked": F.max("acked").over(upto),
                "next": F.lead("received_at").over(order),
            }
        )
        due = F.unix_micros("received_at") + self.wait
        passed = F.lit(True) if clock is None else due <= clock
        rings = ~F.col("acked") & ~F.col("fired") & F.coalesce(due <= F.unix_micros("next"), passed)
        rows = materialize(rows.withColumn("rings", rings), "deliveries")
        status = F.when(F.col("attempts") >= self.most, "exhausted").otherwise("due")
        found = rows.filter("rings").select(
            "message", "attempts", status.alias("status"), F.timestamp_micros(due).alias("due_at")
        )
        carry = rows.filter(F.col("next").isNull()).select(
            "message", "received_at", "stream_seq", "attempts", "acked", (F.col("fired") | F.col("rings")).alias("fired")
        )
        if clock is not None:
            carry = carry.filter(F.unix_micros("received_at") >= clock - self.keep)
        return found, carry
