"""Failure runs, redelivery and metrics on small logs."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from helpers import T0

from pyspark.sql import functions as F
from rowtide.operators import metrics as M, reliability as G

RESULTS = ["processed", "publish_error", "dedup_error", "duplicate", "skipped"]


def outcome_rows(spark, rows):
    data = [(c, T0 + dt.timedelta(seconds=t), s, r) for s, (c, t, r) in enumerate(rows)]
    return spark.createDataFrame(data, "consumer_id string, acked_at timestamp, stream_seq bigint, result string")


def runs(rows, threshold):
    open_runs, out = {}, []
    for seq, (c, t, r) in sorted(enumerate(rows), key=lambda x: (x[1][0], x[1][1], x[0])):
        if r == "processed":
            open_runs.pop(c, None)
        elif r.endswith("_error"):
            if c not in open_runs:
                open_runs[c] = [c, t, t, 0, False]
                out.append(open_runs[c])
            run = open_runs[c]
            run[2], run[3] = t, run[3] + 1
            run[4] = run[4] or t - run[1] > threshold
    return sorted(map(tuple, out))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("bucket", [1, 30, 100_000])
def test_failure_runs(spark, seed, bucket):
    rng = random.Random(seed)
    weights = [2, 5, 3, 2, 1]
    rows = [(f"c{rng.randrange(3)}", rng.randrange(900), rng.choices(RESULTS, weights)[0]) for _ in range(300)]
    got = G.failure_guard(outcome_rows(spark, rows), threshold_seconds=20, bucket_seconds=bucket).collect()
    utc = lambda ts: round((ts.replace(tzinfo=dt.timezone.utc) - T0).total_seconds())
    shown = sorted(
        (r.consumer_id, utc(r.first_failure), utc(r.last_failure), r.failures, r.breached) for r in got
    )
    assert shown == runs(rows, 20)


def test_failures_without_consumer_or_time_are_kept(spark):
    rows = [(None, 0, "publish_error"), (None, 5, "dedup_error"), ("c", 1, "publish_error")]
    out = outcome_rows(spark, rows)
    got = {r.consumer_id: r.failures for r in G.failure_guard(out).collect()}
    assert got == {None: 2, "c": 1}
    timeless = out.withColumn("acked_at", F.when(F.col("stream_seq") > 0, F.col("acked_at")))
    assert {r.consumer_id: r.failures for r in G.failure_guard(timeless).collect()} == {None: 2, "c": 1}


def test_exact_percentile(spark):
    rng = random.Random(4)
    waits = [rng.choice([0.01, 0.3, 2.0, 30.0]) * (1 + rng.random()) for _ in range(333)]
    data = [("processed", T0, T0 + dt.timedelta(seconds=w)) for w in waits]
    out = spark.createDataFrame(data, "result string, received_at timestamp, acked_at timestamp")
    row = M.slo_report(out).collect()
    assert len(row) == 1 and row[0].events == 333
    assert row[0].p95_latency_s == pytest.approx(float(np.quantile(np.round(waits, 6), 0.95)), abs=2e-6)


def test_breach_needs_more_than_the_threshold(spark):
    rows = [("c", 0, "publish_error"), ("c", 900, "publish_error"), ("d", 0, "dedup_error"), ("d", 901, "dedup_error")]
    got = {r.consumer_id: r.breached for r in G.failure_guard(outcome_rows(spark, rows)).collect()}
    assert got == {"c": False, "d": True}


def test_redelivery(spark):
    rows = [
        (1, 0, "nack"), (1, 30, "nack"), (1, 60, "nack"),
        (2, 0, "nack"), (2, 30, "ack"),
        (3, 0, None),
        (4, 0, "nack"), (4, 30, "nack"),
    ]
    data = [(m, T0 + dt.timedelta(seconds=t), s, d) for s, (m, t, d) in enumerate(rows)]
    log = spark.createDataFrame(data, "message bigint, received_at timestamp, stream_seq bigint, disposition string")
    status = G.redelivery_status(log).select("message", "attempts", "status", F.unix_seconds("next_delivery_at").alias("due"))
    t0 = int(T0.timestamp())
    assert sorted(map(tuple, status.collect())) == [
        (1, 3, "exhausted", None), (2, 2, "acked", None), (3, 1, "pending", t0 + 30), (4, 2, "pending", t0 + 60),
    ]


def test_histogram_and_lookup(spark):
    data = [("messages", "processed", d) for d in (0.004, 0.005, 0.3, 99.0)] + [("messages", "duplicate", 1.0)]
    out = spark.createDataFrame(data, "result_table string, result string, duration_s double")
    got = {r.le: (r.bucket_count, r.total_count) for r in M.processing_histogram(out).collect()}
    assert got["0.005"] == (2, 4) and got["0.5"] == (3, 4) and got["10"] == (3, 4) and got["+Inf"] == (4, 4)
    snapshot = spark.createDataFrame(
        [("m", {"a": "1", "b": "2"}, 5.0), ("m", {"a": "1"}, 7.0)], "metric string, labels map<string,string>, value double"
    )
    assert [r.value for r in M.metric_lookup(snapshot, "m", {"a": "1"}).collect()] == [7.0]
    assert M.metric_lookup(snapshot, "m", {}).count() == 0
