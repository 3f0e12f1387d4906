"""Deduplication against a walk in plain Python."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from helpers import MESSAGE, T0, body, log, subject
from pyspark.sql import functions as F

from rowtide.operators import dedup as D
from rowtide.operators.outcomes import outcomes
from rowtide.streaming.dedup import label_arrivals

TTL = 300
SCHEMA = "event_id string, received_at timestamp, stream_seq bigint, ok boolean"


def walk(rows, ttl=TTL):
    """Labels by stream_seq for rows of (key, seconds, seq, ok)."""
    expiry, labels = defaultdict(lambda: None), {}
    for key, at, seq, ok in sorted(rows, key=lambda r: (r[1], r[2])):
        if expiry[key] is not None and at < expiry[key]:
            labels[seq] = "hit"
            continue
        labels[seq] = "miss"
        if ok:
            expiry[key] = at + ttl
    return labels


def frame(spark, rows):
    data = [(k, T0 + dt.timedelta(microseconds=round(t * 1e6)), s, ok) for k, t, s, ok in rows]
    return spark.createDataFrame(data, SCHEMA)


def random_rows(seed, n=600, fail=0.0, span=4000, keys=4):
    rng = random.Random(seed)
    hot = lambda: "hot" if rng.random() < 0.4 else f"k{rng.randrange(keys)}"
    return [(hot(), rng.randrange(span * 4) / 4, s, rng.random() >= fail) for s in range(n)]


def test_worked_example(spark):
    times = [0, 100, 299, 300, 550, 601]
    rows = [("e", t, i, True) for i, t in enumerate(times)]
    kept = D.accepted_deliveries(frame(spark, rows)).collect()
    assert sorted(r.stream_seq for r in kept) == [0, 3, 5]


@pytest.mark.parametrize("seed", [1, 2])
def test_accepted(spark, seed):
    rows = random_rows(seed)
    got = D.accepted_deliveries(frame(spark, rows), TTL).collect()
    want = [s for s, label in walk(rows).items() if label == "miss"]
    assert sorted(r.stream_seq for r in got) == sorted(want)


def test_long_chain_with_gaps_and_ties(spark):
    rng = random.Random(7)
    times = sorted(rng.choice([0, 10_000, 10_300, 50_000]) + rng.randrange(2000) for _ in range(800))
    rows = [("hot", t, i, True) for i, t in enumerate(times)]
    got = D.accepted_deliveries(frame(spark, rows), 7).collect()
    want = [s for s, label in walk(rows, 7).items() if label == "miss"]
    assert sorted(r.stream_seq for r in got) == sorted(want)


def test_evenly_spaced_chain(spark):
    rows = [("hot", i * 0.5, i, True) for i in range(1000)]
    got = D.accepted_deliveries(frame(spark, rows), 3).collect()
    assert sorted(r.stream_seq for r in got) == list(range(0, 1000, 6))


def test_failed_publishing_opens_no_window(spark):
    rows = random_rows(3, fail=0.5)
    flagged = D.flag_deliveries(frame(spark, rows), TTL, published="ok")
    got = {r.stream_seq: r.dedup for r in flagged.collect()}
    assert got == walk(rows)


def test_rows_without_key_pass_unlabelled(spark):
    rows = [("e", 0, 0, True), (None, 0, 1, True), (None, 1, 2, False)]
    got = {r.stream_seq: r.dedup for r in D.flag_deliveries(frame(spark, rows), published="ok").collect()}
    assert got == {0: "miss", 1: None, 2: None}


def test_a_delivery_captured_twice_is_published_once(spark):
    rows = [("e", 0, 0, True), ("e", 0, 0, True), ("e", 0, 0, True), ("e", 400, 1, True), ("f", 1, 2, True)]
    flagged = [(r.stream_seq, r.dedup) for r in D.flag_deliveries(frame(spark, rows), published="ok").collect()]
    assert sorted(flagged) == [(0, "hit"), (0, "hit"), (0, "miss"), (1, "miss"), (2, "miss")]
    assert sorted(r.stream_seq for r in D.accepted_deliveries(frame(spark, rows)).collect()) == [0, 1, 2]
    assert sorted(r.stream_seq for r in D.first_deliveries(frame(spark, rows)).collect()) == [0, 2]


def test_rows_without_time_are_no_duplicates(spark):
    rows = frame(spark, [("e", 0, 0, True), ("e", 1, 1, True)])
    rows = rows.withColumn("received_at", F.when(F.col("stream_seq") == 0, F.col("received_at")))
    assert {r.stream_seq: r.dedup for r in D.flag_deliveries(rows).collect()} == {0: "miss", 1: None}
    same = body("messages", MESSAGE)
    timeless = log(spark, [(subject("messages"), same, 0)]).withColumn("received_at", F.lit(None).cast("timestamp"))
    assert [(r.result, r.error_code) for r in outcomes(timeless).collect()] == [
        ("transform_data_error", "missing_arrival_time")
    ]


def test_arrivals_before_the_window_leave_it(spark):
    second, ttl = 10**6, TTL * 10**6

    def labels(at, expiry):
        new, end = label_arrivals(np.array([t * second for t in at]), np.ones(len(at), bool), expiry * second, ttl)
        return new.tolist(), end // second

    assert labels([500], 1300) == ([True], 1300)
    assert labels([500, 600, 900, 1000, 1299, 1300], 1300) == ([True, False, True, False, False, True], 1600)
    assert labels([999], 1300) == ([True], 1300)


def test_first_deliveries(spark):
    rows = [("a", 5, 0, True), ("a", 1, 1, True), ("a", 1, 2, True), ("b", 9, 3, True)]
    assert sorted(r.stream_seq for r in D.first_deliveries(frame(spark, rows)).collect()) == [1, 3]


def test_label_arrivals_matches_walk():
    for seed in range(30):
        rows = [r for r in random_rows(seed, fail=0.3) if r[0] == "hot"]
        rows.sort(key=lambda r: (r[1], r[2]))
        at = np.array([round(r[1] * 1e6) for r in rows])
        new, _ = label_arrivals(at, np.array([r[3] for r in rows]), -(2**63), TTL * 10**6)
        want = walk(rows)
        assert [("miss" if n else "hit") for n in new] == [want[r[2]] for r in rows]


def test_duplicate_event_counts(spark):
    same = body("messages", MESSAGE)
    m = subject("messages")
    out = outcomes(log(spark, [(m, same, 0), (m, same, 60), (m, same, 300)])).orderBy("stream_seq").collect()
    assert [(r.result, r.dedup, r.disposition) for r in out] == [
        ("processed", "miss", "ack"),
        ("duplicate", "hit", "ack"),
        ("processed", "miss", "ack"),
    ]


def test_publish_failure_is_retried(spark):
    same = body("messages", MESSAGE)
    m = subject("messages")
    out = outcomes(log(spark, [(m, same, 0, False), (m, same, 30, True), (m, same, 60, True)]))
    got = [(r.result, r.disposition) for r in out.orderBy("stream_seq").collect()]
    assert got == [("publish_error", "nack"), ("processed", "ack"), ("duplicate", "ack")]


def test_failed_lookup(spark):
    same = body("messages", MESSAGE)
    m = subject("messages")
    rows = log(spark, [(m, same, 0), (m, same, 30)]).withColumn("dedup_ok", F.col("stream_seq") == 1)
    got = [(r.result, r.disposition, r.dedup) for r in outcomes(rows).orderBy("stream_seq").collect()]
    assert got == [("dedup_error", "nack", None), ("processed", "ack", "miss")]
