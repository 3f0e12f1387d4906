"""Streaming across micro-batches and restarts gives the batch answer."""

from __future__ import annotations

import uuid

import pytest
from helpers import MESSAGE, body, log, subject
from pyspark.sql import functions as F

from rowtide.operators.outcomes import outcomes
from rowtide.session import configure, shared_dir
from rowtide.sources.logs import routed_rows, send, stream_log, write_routed
from rowtide.streaming import run

SF_DIR = "/root/testdata/sf0.001"


def test_restart_between_files(spark):
    same = body("messages", MESSAGE)
    m = subject("messages")
    rows = log(
        spark,
        [
            (m, same, 0), (m, same, 100), (m, "cut", 101), (m, same, 299),
            (m, same, 300), (m, same, 550), (subject("orders"), "{}", 560), (m, same, 601),
        ],
    )
    work = f"{shared_dir(spark)}/restart-{uuid.uuid4().hex}"
    for low, high in ((0, 3), (3, 5), (5, 8)):
        part = rows.filter(F.col("stream_seq").between(low, high - 1))
        part.coalesce(1).write.mode("append").parquet(f"{work}/log")
        run.settle_log(spark, f"{work}/log", work, max_files=1, stamp=F.col("received_at"))
        run.route_events(spark, work)
        run.keep_rejected(spark, work)
    got = {r.stream_seq: r.result for r in spark.read.parquet(f"{work}/outcomes").collect()}
    want = {r.stream_seq: r.result for r in outcomes(rows).collect()}
    assert got == want
    published = spark.read.json(f"{work}/published").collect()
    assert sorted(r.stream_seq for r in published) == [0, 4, 7]
    assert {(r.company_id, r.logical) for r in published} == {("company-d0", "messages")}
    assert [r.stream_seq for r in spark.read.parquet(f"{work}/quarantine").collect()] == [2]


def test_late_rows_are_settled_and_counted(spark):
    same, other = body("messages", MESSAGE), body("messages", {**MESSAGE, "message_id": "m2"}, lsn=7)
    m = subject("messages")
    work = f"{shared_dir(spark)}/late-{uuid.uuid4().hex}"
    for part in ([(m, same, 90_000)], [(m, other, 10), (m, same, 500), (m, same, 90_010), (m, "cut", 1)]):
        rows = log(spark, part).withColumn("stream_seq", F.col("stream_seq") + len(part) * 10)
        rows.coalesce(1).write.mode("append").parquet(f"{work}/log")
        run.settle_log(spark, f"{work}/log", work, max_files=1, stamp=F.col("received_at"))
        run.keep_rejected(spark, work)
        run.count_outcomes(spark, work)
    got = {r.stream_seq: r.result for r in spark.read.parquet(f"{work}/outcomes").collect()}
    assert got == {10: "processed", 40: "processed", 41: "processed", 42: "duplicate", 43: "unmarshal_error"}
    assert [r.body for r in spark.read.parquet(f"{work}/quarantine").collect()] == ["cut"]
    streamed = run.metrics_snapshot(spark, work).filter("metric = 'cdc_consumer_events_total'").collect()
    assert {r.labels["result"]: r.value for r in streamed} == {"processed": 3, "duplicate": 1, "unmarshal_error": 1}


def test_wrong_settings_are_refused(spark):
    rows = log(spark, [(subject("messages"), "{}")])
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        with pytest.raises(ValueError, match="allowDuplicateKeys"):
            outcomes(rows)
    finally:
        configure(spark)


def test_any_sink(spark):
    events = spark.createDataFrame([("websocket.co1.a.chats", "{}")], "target_subject string, payload string")
    path = f"{shared_dir(spark)}/sent-{uuid.uuid4().hex}"
    send(events, "parquet", path=path, compression="none")
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("websocket.co1.a.chats", "{}")]


def test_intake_is_bounded(spark):
    work = f"{shared_dir(spark)}/intake-{uuid.uuid4().hex}"
    rows = log(spark, [(subject("messages"), "{}", i) for i in range(6)])
    for i in range(3):
        rows.filter(F.col("stream_seq") % 3 == i).coalesce(1).write.mode("append").parquet(f"{work}/log")
    query = (
        stream_log(spark, f"{work}/log", max_files=1)
        .writeStream.format("parquet")
        .option("path", f"{work}/out")
        .option("checkpointLocation", f"{work}/cp")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [2, 2, 2]


def test_batch_sink_layout(spark):
    events = spark.createDataFrame(
        [("co1", "chats", "e1", "websocket.co1.a.chats", "{}"), ("co2", "agents", "e2", "websocket.co2.a.agents", "{}")],
        "company_id string, logical string, event_id string, target_subject string, payload string",
    )
    path = f"{shared_dir(spark)}/routed-{uuid.uuid4().hex}"
    write_routed(events, path)
    one = spark.read.json(path).filter("company_id = 'co1'")
    assert [r.event_id for r in one.collect()] == ["e1"]
    assert routed_rows(events).columns == ["key", "value"]
