"""The one-pass stream: windows under disorder, replays, the upsert sink, counters, runs of failures."""

from __future__ import annotations

import datetime as dt
import random
import uuid

import numpy as np
import pytest
from helpers import MESSAGE, T0, body, log, subject
from pyspark.sql import functions as F
from test_dedup import TTL, frame, walk

from rowtide.operators import dedup as D, events, metrics
from rowtide.operators.outcomes import outcomes
from rowtide.session import materialize, scratch, shared_dir
from rowtide.sources import upsert
from rowtide.sources.store import BatchLog, WindowStore, committed, names
from rowtide.streaming import flow
from rowtide.streaming.dedup import label_among

M = subject("messages")


def folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def flags(spark, out):
    return {r.stream_seq: r.dedup for r in committed(spark, out, "flagged").collect()}


def keyed(spark, rows):
    return frame(spark, [(k, t, s, True) for k, t, s in rows]).drop("ok")


def test_arrivals_in_the_wrong_order_stay_inside_known_windows(spark):
    out = folder(spark, "disorder")
    for number, (at, seq) in enumerate([(1000, 0), (500, 1), (600, 2), (800, 3), (1299, 4), (1300, 5), (699, 6), (200, 7)]):
        flow.dedup_run(keyed(spark, [("e", at, seq)]), out, number)
    # 800 comes less than a ttl before 1000, which was sent already; 200 ends where 500 begins.
    assert flags(spark, out) == {0: "miss", 1: "miss", 2: "hit", 3: "hit", 4: "hit", 5: "miss", 6: "hit", 7: "miss"}


def test_state_function_agrees_with_windows():
    second, rng = 10**6, random.Random(2)
    for _ in range(50):
        known = np.array(sorted({rng.randrange(20) * 400 for _ in range(4)})) * second
        at = np.sort(np.array([rng.randrange(0, 9000) for _ in range(12)])) * second
        opens = np.array([rng.random() < 0.8 for _ in at])
        new, after = label_among(at, opens, known, TTL * second)
        starts = sorted(after.tolist())
        assert all(b - a >= TTL * second for a, b in zip(starts, starts[1:]))
        for t, is_new, is_open in zip(at.tolist(), new.tolist(), opens.tolist()):
            inside = any(w <= t < w + TTL * second for w in starts if not (is_new and is_open and w == t))
            assert not (is_new and inside) and (is_new or inside or (is_open and any(t < w < t + TTL * second for w in starts)))


def test_runs_continue_each_other(spark):
    """A log cut in three, each run once again: the answer of one run."""
    rng = random.Random(5)
    rows = [(f"k{rng.randrange(12)}", rng.randrange(5000), s) for s in range(400)]
    rows.sort(key=lambda r: r[1])
    out = folder(spark, "continued")
    for number in range(3):
        part = keyed(spark, rows[number * 133 : (number + 1) * 133 + (number == 2)])
        flow.dedup_run(part, out, number)
        flow.dedup_run(part, out, number)
    assert flags(spark, out) == walk([(*r, True) for r in rows])


def test_windows_of_other_times_are_not_read(spark):
    store, second = WindowStore(spark, folder(spark, "windows")), 10**6
    start = round(T0.timestamp()) * second

    def span(number):
        return start + number * 3600 * second, start + (number * 3600 + 1800) * second

    for number in range(6):
        rows = frame(spark, [("e", number * 3600 + 300 * k, k, True) for k in range(7)])
        for _ in range(2):
            store.add(rows, number, *span(number))
    low = start + 3 * 3600 * second
    near = store.near(low, low + 400 * second, 6, TTL)
    assert {f.split("/batch_")[1].split("_")[0] for f in near.inputFiles()} == {"3"}
    assert sorted((r.received_at - T0.replace(tzinfo=None)).seconds for r in near.collect()) == [10800, 11100, 11400]
    assert "PushedFilters: [IsNotNull(received_at), GreaterThanOrEqual" in near._jdf.queryExecution().toString()
    assert store.near(low, low, 3, TTL) is None and store.near(None, None, 6, TTL) is None
    store.expire(low)
    assert sorted(n.split("_")[1] for n in names(spark, store.path)) == ["3", "4", "5"]


def test_unfinished_batches_do_not_count(spark):
    out = folder(spark, "unfinished")
    flow.dedup_run(keyed(spark, [("e", 0, 0)]), out, 0)
    rows, settler = keyed(spark, [("e", 10, 1), ("f", 20, 2)]), flow.Settler(spark, out, TTL, 0, 10**6)

    def label(part, windows):
        return D.flag_deliveries(part, TTL, windows=windows, row="_row").drop("_row")

    def broken(done, number):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        settler.run(rows, 1, label, broken, name="flagged")
    assert flags(spark, out) == {0: "miss"} and BatchLog(spark, f"{out}/commits").last()[0] == 0
    settler.run(rows, 1, label, name="flagged")
    assert flags(spark, out) == {0: "miss", 1: "hit", 2: "miss"}


def test_failed_publishing_opens_no_known_window(spark):
    rows = [("e", 0, 0, False), ("e", 10, 1, True), ("f", 5, 2, True)]
    late = [("e", 20, 3, False), ("f", 400, 4, False), ("f", 410, 5, True), ("f", 420, 6, False)]
    first = D.flag_deliveries(frame(spark, rows), TTL, published="ok")
    opened = materialize(first.filter("dedup = 'miss' AND ok").select("event_id", "received_at"), "opened")
    second = D.flag_deliveries(frame(spark, late), TTL, published="ok", windows=opened)
    got = {r.stream_seq: r.dedup for r in first.unionByName(second).collect()}
    assert got == walk(rows + late)
    numbered = materialize(frame(spark, late).withColumn("n", F.monotonically_increasing_id()), "numbered")
    by_row = D.flag_deliveries(numbered, TTL, published="ok", windows=opened, row="n")
    assert {r.stream_seq: r.dedup for r in by_row.collect()} == {s: got[s] for s in (3, 4, 5, 6)}


def test_numbered_rows_give_the_same_labels(spark):
    rng = random.Random(11)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), rng.randrange(4000), s // 2, rng.random() < 0.7) for s in range(300)]
    rows = [(*r[:2], i // 2, True) if i % 2 == 0 else (*rows[i - 1][:2], i // 2, True) for i, r in enumerate(rows)]
    numbered = materialize(frame(spark, rows).withColumn("n", F.monotonically_increasing_id()), "numbered")
    plain = D.flag_deliveries(numbered, TTL, published="ok")
    by_row = D.flag_deliveries(numbered, TTL, published="ok", row="n")
    count = lambda df: sorted((str(r.event_id), r.stream_seq, str(r.dedup)) for r in df.collect())
    assert count(plain) == count(by_row)


def test_narrow_outcomes(spark):
    rows = log(spark, [(M, body("messages", MESSAGE), 0), (M, body("messages", MESSAGE), 9), (M, "cut", 10)])
    whole = outcomes(rows).select("stream_seq", "result", "dedup").collect()
    narrow = outcomes(rows, columns=["stream_seq", "result", "dedup"])
    assert narrow.columns == ["stream_seq", "result", "dedup"] and sorted(narrow.collect()) == sorted(whole)


def test_scratch_tables_go(spark):
    with scratch(spark):
        table = materialize(spark.range(3), "short")
        path = table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
        assert table.count() == 3
    assert names(spark, path) == []


# -- the flow ------------------------------------------------------------------------------------


def write(spark, work, rows, offset):
    part = log(spark, rows).withColumn("stream_seq", F.col("stream_seq") + offset)
    part.coalesce(1).write.mode("append").parquet(f"{work}/log")


def sinks(spark, work):
    sent = {(r.event_id, r.stream_seq) for r in upsert.latest_events(spark, f"{work}/events").collect()}
    kept = sorted(r.body for r in committed(spark, work, "quarantine").collect())
    counts = {(r.metric, str(r.labels)): r.value for r in flow.metrics_snapshot(spark, work).collect()}
    return sent, kept, counts


def test_one_pass_replay_and_fold(spark):
    work = folder(spark, "flow")
    other = body("messages", {**MESSAGE, "message_id": "m2"}, lsn=7)
    same = body("messages", MESSAGE)
    write(spark, work, [(M, same, 0), (M, "cut", 1), (M, same, 100)], 0)
    options = {"stamp": F.col("received_at"), "max_files": 1}
    flow.pipeline_stream(spark, f"{work}/log", work, **options)
    write(spark, work, [(M, same, 299), (M, same, 300), (M, other, 301, False)], 10)
    flow.pipeline_stream(spark, f"{work}/log", work, **options)
    results = {r.stream_seq: r.result for r in committed(spark, work, "outcomes").collect()}
    assert results == {
        0: "processed", 1: "unmarshal_error", 2: "duplicate", 10: "duplicate", 11: "processed", 12: "publish_error"
    }
    before = sinks(spark, work)
    assert {seq for _, seq in before[0]} == {11} and before[1] == ["cut"]
    # The last batch once more, as after a crash between its commit and the checkpoint's.
    number, _ = BatchLog(spark, f"{work}/commits").last()
    again = committed(spark, work, "outcomes").filter(F.col("batch") == number).drop("batch")
    flow._fan_out(work, flow.SINKS)(materialize(again, "again"), number)
    assert sinks(spark, work) == before
    flow.Settler(spark, work, TTL, 0, 10**6).run(again, number, lambda rows, windows: rows)
    assert sinks(spark, work) == before
    flow.fold_metrics(spark, work)
    upsert.compact(spark, f"{work}/events")
    assert sinks(spark, work) == before
    assert names(spark, f"{work}/events/delta") == [] and len(names(spark, f"{work}/metrics/summary")) <= 2


def test_upsert_keeps_the_last_delivery_once(spark):
    path = folder(spark, "upsert")
    out = outcomes(log(spark, [(M, body("messages", MESSAGE), 0), (M, body("messages", MESSAGE), 300)]))
    sent = materialize(events.published(out).drop("row_data"), "sent")
    for number in (0, 0, 1, 1):
        upsert.upsert_batch(sent.filter(F.col("stream_seq") == number), path, number)
    assert [r.stream_seq for r in upsert.latest_events(spark, path).collect()] == [1]
    upsert.compact(spark, path)
    upsert.upsert_batch(sent.filter("stream_seq = 0"), path, 1)  # done already
    upsert.upsert_batch(sent.filter("stream_seq = 0"), path, 2)
    assert [r.stream_seq for r in upsert.latest_events(spark, path).collect()] == [1]
    assert upsert.manifest(spark, path) == {"base": "base-1", "upto": 1, "batches": [2]}


def test_falling_lag(spark):
    """A gauge falls with the last batch; a consumer that is silent keeps its value."""
    parts = [("c0", 0, 9_000_000), ("c1", 0, 5_000_000), ("c0", 1, 2_000_000), ("c1", 1, None)]
    frame_ = spark.createDataFrame(parts, "consumer_id string, batch int, lag_us bigint")
    assert {r.consumer_id: r.lag_seconds for r in metrics.last_lag(frame_).collect()} == {"c0": 2.0, "c1": 5.0}


def test_delay_orders_overlapping_batches(spark):
    """Held back, arrivals of overlapping batches get the labels of one batch."""
    rng = random.Random(8)
    rows = [(f"k{rng.randrange(6)}", rng.randrange(3000), s) for s in range(250)]
    shuffled = sorted(rows, key=lambda r: r[1] + rng.randrange(-150, 151))
    out = folder(spark, "delay")
    settler = flow.Settler(spark, out, TTL, 300, 10**6)

    def label(part, windows):
        return D.flag_deliveries(part, TTL, windows=windows, row="_row").drop("_row")

    for number in range(3):
        settler.run(keyed(spark, shuffled[number * 84 : (number + 1) * 84]), 2 * number, label, name="flagged")
    assert len(flags(spark, out)) < len(rows)
    settler.finish(label, name="flagged")
    assert flags(spark, out) == walk([(*r, True) for r in rows])
    assert dt.timedelta(seconds=TTL) < dt.timedelta(seconds=settler.keep)
