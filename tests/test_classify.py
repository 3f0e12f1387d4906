"""The decision table, row by row, and the strictness of decoding."""

from __future__ import annotations

import json

import pytest
from helpers import MESSAGE, body, log, subject
from hypothesis import HealthCheck, given, settings, strategies as st

from rowtide.functions.subjects import matches_pattern, parse_subject
from rowtide.operators import classify as C
from pyspark.sql import functions as F

M = subject("messages")


def msg(**changes):
    return {k: v for k, v in {**MESSAGE, **changes}.items() if v is not ...}


CASES = {
    "ok": (M, body("messages", msg(text="x", message_date="2025-05-17")), None),
    "five tokens": ("sequin.changes.appdb.public.messages", "{}", "invalid_subject"),
    "wrong prefix": ("other.changes.appdb.public.messages.insert", "{}", "invalid_subject"),
    "empty token": ("sequin.changes.appdb..messages.insert", "{}", "invalid_subject"),
    "no subject": (None, "{}", "invalid_subject"),
    "skipped": (subject("user_profiles"), body("user_profiles", {}), "table_not_allowed"),
    "skipped unread": (subject("user_profiles"), "not json", "table_not_allowed"),
    "no body": (M, None, "undecodable"),
    "empty body": (M, "", "undecodable"),
    "blank body": (M, "  ", "undecodable"),
    "cut": (M, body("messages", msg())[:20], "undecodable"),
    "trailing text": (M, body("messages", msg()) + " x", "undecodable"),
    "trailing brace": (M, body("messages", msg()) + "}", "undecodable"),
    "two values": (M, body("messages", msg()) + "," + body("messages", msg()), "undecodable"),
    "trailing member": (M, body("messages", msg()) + ',"x":1', "undecodable"),
    "second document": (M, 'null,"doc":' + body("messages", msg()), "undecodable"),
    "second end": (M, body("messages", msg()) + ',"__end__":1', "undecodable"),
    "closed by hand": (M, body("messages", msg()) + ',"__end__":1}', "undecodable"),
    "closed with a tail": (M, body("messages", msg()) + ',"__end__":1} trailing garbage', "undecodable"),
    "closed as a list": (M, body("messages", msg()) + '], [{"a":1}', "undecodable"),
    "tiny fraction": (M, body("messages", msg(id=0)).replace('"id": 0', '"id": 12.0000000001'), "type_mismatch"),
    "whole fraction": (M, body("messages", msg(id=0)).replace('"id": 0', '"id": 12.000'), None),
    "single quotes": (M, body("messages", msg()).replace('"', "'"), "undecodable"),
    "array body": (M, "[1]", "undecodable"),
    "number body": (M, "5", "undecodable"),
    "record array": (M, body("messages", [1]), "undecodable"),
    "record text": (M, body("messages", "x"), "undecodable"),
    "changes array": (M, body("messages", msg(), changes=[1]), "undecodable"),
    "changes object": (M, body("messages", msg(), changes={"status": "old"}), None),
    "changes null": (M, body("messages", msg(), changes=None), None),
    "quoted lsn": (M, body("messages", msg(), metadata={"commit_lsn": "5"}), "undecodable"),
    "fraction lsn": (M, body("messages", msg(), metadata={"commit_lsn": 5.0}), "undecodable"),
    "number table": (M, body(5, msg()), "undecodable"),
    "number action": (M, '{"action":1,"metadata":{"table_name":"messages"}}', "undecodable"),
    "metadata text": (M, '{"metadata":"x"}', "undecodable"),
    "sink text": (M, body("messages", msg(), metadata={"sink": "x"}), "undecodable"),
    "sink id number": (M, body("messages", msg(), metadata={"sink": {"id": 1}}), "undecodable"),
    "annotations list": (M, body("messages", msg(), metadata={"transaction_annotations": []}), "undecodable"),
    "null body": (M, "null", "empty_table_name"),
    "empty object": (M, "{}", "empty_table_name"),
    "empty table": (M, body("", msg()), "empty_table_name"),
    "null table": (M, body(None, msg()), "empty_table_name"),
    "unknown table": (M, body("orders", msg()), "unknown_table"),
    "null record": (M, body("messages", None), "null_record"),
    "absent record": (M, '{"metadata":{"table_name":"messages"}}', "null_record"),
    "text id": (M, body("messages", msg(id="pk123")), "type_mismatch"),
    "whole float id": (M, body("messages", msg(id=12.0)), None),
    "fraction id": (M, body("messages", msg(id=12.5)), "type_mismatch"),
    "huge id": (M, body("messages", msg(id=2**63)), "type_mismatch"),
    "largest id": (M, body("messages", msg(id=2**63 - 1)), None),
    "exponent id": (M, body("messages", msg()).replace('"agent_id"', '"id":1e2,"agent_id"'), None),
    "null id": (M, body("messages", msg(id=None)), None),
    "object text": (M, body("messages", msg(flow={"a": 1})), "type_mismatch"),
    "text bool": (M, body("messages", msg(is_deleted="no")), "type_mismatch"),
    "empty date": (M, body("messages", msg(message_date="")), None),
    "null date": (M, body("messages", msg(message_date=None)), None),
    "short date": (M, body("messages", msg(message_date="2025-3-5")), "type_mismatch"),
    "impossible date": (M, body("messages", msg(message_date="2025-02-30")), "type_mismatch"),
    "timestamp date": (M, body("messages", msg(message_date="2025-03-05T00:00:00Z")), "type_mismatch"),
    "number date": (M, body("messages", msg(message_date=20250305)), "type_mismatch"),
    "any key": (M, body("messages", msg(key=[1, {"a": None}])), None),
    "int32 ok": (subject("chats"), body("chats", {**MESSAGE, "unread_count": 7}), None),
    "int32 over": (subject("chats"), body("chats", {**MESSAGE, "unread_count": 2**31}), "type_mismatch"),
    "agent time": (subject("agents"), body("agents", {**MESSAGE, "created_at": "2025-03-15T10:00:00.5Z"}), None),
    "agent offset": (subject("agents"), body("agents", {**MESSAGE, "created_at": "2025-03-15T10:00:00+07:00"}), None),
    "agent date": (subject("agents"), body("agents", {**MESSAGE, "created_at": "2025-03-15"}), "type_mismatch"),
    "agent no time": (subject("agents"), body("agents", {**MESSAGE, "created_at": ""}), "type_mismatch"),
    "contact number id": (subject("contacts"), body("contacts", {**MESSAGE, "id": 5}), "type_mismatch"),
    "contact": (subject("contacts"), body("contacts", {**MESSAGE, "id": "c:1"}), None),
    "no pk": (M, body("messages", msg(message_id=...)), "empty_pk"),
    "null company": (M, body("messages", msg(company_id=None)), "missing_company_id"),
    "empty agent": (M, body("messages", msg(agent_id="")), "empty_agent_id"),
    "no chat": (M, body("messages", msg(chat_id=...)), "missing_chat_id"),
    "mismatch": (M, body("contacts", {**MESSAGE, "id": "c1"}), None),
}


@pytest.fixture(scope="module")
def classified(spark):
    rows = log(spark, [(s, d) for s, d, _ in CASES.values()])
    out = C.classify(rows).drop("record").collect()
    return dict(zip(CASES, sorted(out, key=lambda r: r.stream_seq)))


@pytest.mark.parametrize("name", CASES)
def test_error_code(classified, name):
    assert classified[name].error_code == CASES[name][2]


def test_happy_message(classified):
    row = classified["ok"]
    assert row.event_id == "1632321:messages:msg-c9"
    assert row.target_subject == "websocket.company-d0.agent-a7.messages.chat-b8"
    assert row.unhandled_fields == ["text"]
    assert row.result is None


def test_payload_table_wins(classified):
    row = classified["mismatch"]
    assert row.event_id == "1632321:contacts:c1"
    assert row.target_subject == "websocket.company-d0.agent-a7.contacts"
    assert (row.result_table, row.payload_table) == ("messages", "contacts")


def test_drift_counted_on_rows_that_fail_later(classified, spark):
    assert classified["no pk"].unhandled_fields == []
    rows = log(spark, [(M, body("messages", {"b": 1, "a": 2, "company_id": "c"}))])
    assert C.classify(rows).first().unhandled_fields == ["a", "b"]


def test_stage_and_preview(classified):
    assert classified["no pk"].error_stage == "extract_pk"
    assert classified["null record"].error_stage == "populate_typed_data"
    assert bytes(classified["cut"].preview).decode() == CASES["cut"][1]
    assert classified["ok"].preview is None


def test_duplicate_keys_last_wins(spark):
    text = body("messages", msg()).replace('"message_id"', '"message_id":"first","message_id"')
    assert C.classify(log(spark, [(M, text)])).first().pk == "msg-c9"


def test_subject_parts(spark):
    rows = spark.createDataFrame([("sequin.changes.db..t.insert",), ("a.b.c.d.e.f",), ("x",)], "subject string")
    got = [r.subject_info for r in parse_subject(rows).collect()]
    assert [(g.prefix, g.database_name, g.table_name, g.is_valid) for g in got] == [
        ("sequin.changes", "db", "t", False),
        ("a.b", "", "", False),
        ("", "", "", False),
    ]


@pytest.mark.parametrize(
    "pattern, matching",
    [
        ("a.*", ["a.b"]),
        ("a.>", ["a.b", "a.b.c"]),
        ("*.b, a.b.c", ["a.b", "a.b.c"]),
        ("a+b.*", ["a+b.c"]),
        (">", ["a.b", "a.b.c", "a", "a+b.c"]),
    ],
)
def test_patterns(spark, pattern, matching):
    rows = spark.createDataFrame([(s,) for s in ["a.b", "a.b.c", "a", "a+b.c", "a..b"]], "s string")
    got = [r.s for r in rows.filter(matches_pattern(F.col("s"), pattern)).collect()]
    assert got == [s for s in ["a.b", "a.b.c", "a", "a+b.c"] if s in matching]


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**70), 2**70) | st.floats(allow_nan=False) | st.text(max_size=5),
    lambda v: st.lists(v, max_size=3) | st.dictionaries(st.sampled_from(["id", "k", "chat_id"]), v, max_size=3),
    max_leaves=6,
)
bodies = st.one_of(
    st.text(max_size=30),
    json_values.map(json.dumps),
    st.fixed_dictionaries(
        {"metadata": st.fixed_dictionaries({"table_name": st.sampled_from(["messages", "chats", "agents", ""])})},
        optional={"record": json_values, "changes": json_values, "action": json_values},
    ).map(json.dumps),
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(bodies, min_size=40, max_size=80))
def test_every_body_gets_one_verdict(spark, texts):
    out = C.classify(log(spark, [(M, t) for t in texts])).drop("record").collect()
    assert len(out) == len(texts)
    for row in out:
        assert (row.error_code is None) == (row.event_id is not None) == (row.target_subject is not None)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet='{}[],:"1 \n_end', max_size=14) | st.sampled_from([',"__end__":1}', "} ", "]", '}],[{"a":1']), min_size=60, max_size=90))
def test_nothing_may_follow_the_value(spark, tails):
    whole = body("messages", MESSAGE)

    def alone(text):
        try:
            json.loads(text)
        except ValueError:
            return False
        return True

    out = C.classify(log(spark, [(M, whole + tail) for tail in tails])).select("stream_seq", "error_code").collect()
    got = {r.stream_seq: r.error_code != "undecodable" for r in out}
    assert got == {i: alone(whole + tail) for i, tail in enumerate(tails)}
