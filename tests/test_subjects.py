"""Patterns over layouts, and many patterns at once."""

from __future__ import annotations

import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from rowtide.functions.subjects import pattern_to_regex
from rowtide.operators.subscriptions import matching_subscribers
from rowtide.session import shared_dir
from rowtide.sources.logs import read_routed, write_routed

SUBJECTS = [
    f"websocket.{c}.{a}.{t}"
    for c in ("co1", "co2", "co3")
    for a in ("a1", "a2")
    for t in ("chats", "agents", "messages.chat1", "messages.x.y")
] + ["websocket.co.1.a1.chats", "websocket.co1.a.1.chats", "websocket.co1.a.1.messages.c"]


def events(spark, subjects=SUBJECTS):
    rows = [(f"e{i}", i, s, "{}") for i, s in enumerate(subjects)]
    return spark.createDataFrame(rows, "event_id string, stream_seq bigint, target_subject string, payload string")


@pytest.fixture(scope="module")
def layout(spark):
    path = f"{shared_dir(spark)}/layout-{uuid.uuid4().hex}"
    write_routed(events(spark), path)
    return path


PATTERNS = [
    "websocket.co1.*.messages.>", "websocket.co2.*.agents, websocket.co1.a1.chats", "websocket.>", "websocket.*.a1.>",
    "*.*.*.chats", "websocket.co.>", "other.>", "websocket.co1.a.1.chats", "websocket.co1", "", "websocket.co1.a1.*.*",
]


@pytest.mark.parametrize("patterns", PATTERNS)
def test_layout_reads_what_the_patterns_match(spark, layout, patterns):
    got = sorted(r.target_subject for r in read_routed(spark, layout, patterns).collect())
    regexes = [pattern_to_regex(p) for p in patterns.split(",") if p.strip()]
    assert got == sorted(s for s in SUBJECTS if any(re.match(x, s) for x in regexes))


def test_patterns_prune_folders(spark, layout):
    one = read_routed(spark, layout, "websocket.co1.*.messages.>")
    plan = spark._jvm.PythonSQLUtils.explainString(one._jdf.queryExecution(), "formatted")
    filters = re.search(r"PartitionFilters: \[(.*?)\]\n", plan).group(1)
    assert "company_id" in filters and "co1" in filters and "logical" in filters and "messages" in filters


def test_many_patterns_at_once(spark):
    rng = random.Random(4)
    tokens = ["websocket", "co1", "co2", "a1", "a2", "chats", "messages", "*", "*", "x"]
    patterns = {".".join(rng.choice(tokens) for _ in range(rng.randrange(1, 6))) for _ in range(800)}
    patterns |= {p + ".>" for p in list(patterns)[:300]} | {">", "websocket.>", "websocket.*.*.chats"}
    rows = [(f"s{i}", p) for i, p in enumerate(sorted(patterns))] + [("none", None)]
    table = spark.createDataFrame(rows, "subscriber string, pattern string")
    subjects = [*SUBJECTS, "websocket..a1.chats", "", "x", None]
    heard = matching_subscribers(events(spark, subjects), table)
    got = sorted((r.subscriber, r.stream_seq) for r in heard.collect())
    usable = [s if s is not None and "" not in s.split(".") else None for s in subjects]
    want = [
        (name, i) for name, p in rows if p for i, s in enumerate(usable) if s is not None and re.match(pattern_to_regex(p), s)
    ]
    assert got == sorted(want)
    plan = heard._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert matching_subscribers(events(spark), table.filter(F.lit(False))).collect() == []
