"""Watches over several micro-batches against the batch operators and plain rules."""

from __future__ import annotations

import datetime as dt
import random
import uuid

from helpers import T0

from rowtide.operators import reliability as G
from rowtide.session import shared_dir
from rowtide.streaming.watch import FailureWatch, RedeliveryWatch

SCHEMA = "consumer_id string, acked_at timestamp, received_at timestamp, stream_seq bigint, result string, disposition string, message string"


def outcomes(spark, rows):
    """Rows of (consumer, seconds, seq, result, disposition, message)."""
    at = lambda t: None if t is None else T0 + dt.timedelta(seconds=t)
    return spark.createDataFrame([(c, at(t), at(t), s, r, d, m) for c, t, s, r, d, m in rows], SCHEMA)


def folder(spark):
    return f"{shared_dir(spark)}/watch-{uuid.uuid4().hex}"


def found(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def test_runs_of_failures_over_batches(spark):
    rng = random.Random(3)
    kinds = ["processed", "publish_error", "publish_error", "dedup_error", "duplicate", "skipped"]
    rows = [(rng.choice(["c0", "c1", None]), t * 7, t, rng.choice(kinds), "ack", "m") for t in range(150)]
    mixed = sorted(rows, key=lambda r: r[1] + rng.randrange(-40, 41))
    watch = FailureWatch(spark, folder(spark), delay_seconds=100)
    cuts = (0, 30, 31, 90, 150)
    for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
        for _ in range(1 + (number == 2)):  # a batch that is run again changes nothing
            watch.step(outcomes(spark, mixed[a:b]), 2 * number)
    watch.flush()
    assert found(watch.runs(60)) == found(G.failure_guard(outcomes(spark, rows), 60))


def test_a_run_is_reported_while_it_lasts(spark):
    watch = FailureWatch(spark, folder(spark))
    watch.step(outcomes(spark, [("c", 0, 0, "publish_error", "nack", "m")]), 0)
    assert [(r.failures, r.breached) for r in watch.runs(60).collect()] == [(1, False)]
    watch.step(outcomes(spark, [("c", 61, 1, "dedup_error", "nack", "m"), ("d", 9, 2, "processed", "ack", "n")]), 2)
    assert [(r.failures, r.breached) for r in watch.runs(60).collect()] == [(2, True)]
    watch.step(outcomes(spark, [("c", 62, 3, "processed", "ack", "m"), ("c", 70, 4, "publish_error", "nack", "m")]), 4)
    assert sorted((r.failures, r.breached) for r in watch.runs(60).collect()) == [(1, False), (2, True)]


def test_timers_go_off_without_input_of_their_own(spark):
    """A message that is never answered is due after the wait, and exhausted at the third delivery."""
    watch = RedeliveryWatch(spark, folder(spark))
    got = lambda: sorted((r.message, r.attempts, r.status) for r in watch.found().collect())
    watch.step(outcomes(spark, [("c", 0, 0, None, None, "a"), ("c", 0, 1, "processed", "ack", "b")]), 0)
    assert got() == []
    watch.step(outcomes(spark, [("c", 29, 2, "publish_error", "nack", "other")]), 2)
    assert got() == []
    watch.step(outcomes(spark, [("c", 30, 3, "processed", "ack", "clock")]), 4)
    assert got() == [("a", 1, "due")]
    watch.step(outcomes(spark, [("c", 31, 4, None, None, "a"), ("c", 62, 5, None, None, "a"), ("c", 63, 6, None, None, "z")]), 6)
    assert got() == [("a", 1, "due"), ("a", 2, "due"), ("other", 1, "due")]
    watch.step(outcomes(spark, [("c", 95, 7, "processed", "ack", "z"), ("c", None, 8, None, None, "timeless")]), 8)
    assert got() == [("a", 1, "due"), ("a", 2, "due"), ("a", 3, "exhausted"), ("other", 1, "due"), ("z", 1, "due")]
    watch.flush()
    assert len(got()) == 5
