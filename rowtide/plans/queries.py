"""Every operator as a query over the change log derived from ``events``.

Times come out as microseconds or text and structures as scalars, so that the
answers can be compared with SQL written against the base table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowtide.functions import records as R
from rowtide.functions.envelope import decode_envelope
from rowtide.functions.subjects import parse_subject, subject_filter, table_filter
from rowtide.operators import classify as C, dedup as D, events as E, metrics as M, reliability as G
from rowtide.operators.outcomes import outcomes
from rowtide.operators.subscriptions import matching_subscribers
from rowtide.schemas import AGENTS, CHATS, CONTACTS, DEFAULT_TABLES, MESSAGES, TableSpec, known_fields
from rowtide.session import materialize, shared_dir
from rowtide.sources.event_log import cdc_log
from rowtide.sources.logs import read_routed, write_routed

Query = Callable[[SparkSession, str], DataFrame]
SEQ = "stream_seq"


def _micros(name: str, alias: str) -> Column:
    return F.unix_micros(name).alias(alias)


def _joined(name: str) -> Column:
    return F.array_join(name, ",").alias(name)


def _routable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.classify(cdc_log(spark, sf_dir)).filter(F.col("result").isNull())


def _outcomes(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Outcomes with the named columns; deduplication writes no others."""
    return outcomes(cdc_log(spark, sf_dir), columns=columns)


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose image fits their table, with the known fields."""
    log = C.with_subject(cdc_log(spark, sf_dir))
    return C.with_record(C.with_envelope(log)).filter(F.size("type_errors") == 0)


# -- sources, subjects, envelope -----------------------------------------------------


def cdc_scan(spark, sf_dir):
    return cdc_log(spark, sf_dir).select(
        SEQ, "subject", _micros("received_at", "received_us"), "consumer_id", "sink_ok", "dedup_ok", "duration_s"
    )


def subject_pattern_filter(spark, sf_dir):
    wanted = "sequin.changes.*.*.messages.*, sequin.changes.*.*.agents.>"
    return subject_filter(cdc_log(spark, sf_dir), wanted).select(SEQ, "subject")


def parse_subject_query(spark, sf_dir):
    return parse_subject(cdc_log(spark, sf_dir)).select(SEQ, "subject_info.*")


def events_by_action(spark, sf_dir):
    parsed = parse_subject(cdc_log(spark, sf_dir)).filter("subject_info.is_valid")
    return parsed.groupBy(F.col("subject_info.action").alias("action")).agg(F.count("*").alias("n"))


def decode_envelope_query(spark, sf_dir):
    return decode_envelope(cdc_log(spark, sf_dir)).select(
        SEQ,
        "decodable",
        "action",
        "table_schema",
        "table_name",
        "commit_lsn",
        F.col("record").isNotNull().alias("has_record"),
    )


def _enveloped(spark, sf_dir):
    return C.with_envelope(C.with_subject(cdc_log(spark, sf_dir))).filter("decodable")


def authoritative_table(spark, sf_dir):
    named = F.when(F.col("payload_table") != "", F.col("payload_table"))
    return _enveloped(spark, sf_dir).select(
        SEQ,
        "subject_table",
        named.alias("table"),
        F.when(named.isNull(), C.STAGE_OF_CODE["empty_table_name"]).alias("error_stage"),
    )


def table_mismatch(spark, sf_dir):
    return (
        _enveloped(spark, sf_dir)
        .withColumn("mismatch", C.table_mismatch())
        .groupBy("subject_table", "payload_table", "mismatch")
        .agg(F.count("*").alias("n"))
    )


def event_time_rfc3339(spark, sf_dir):
    return cdc_log(spark, sf_dir).select(SEQ, R.format_rfc3339(F.col("received_at")).alias("event_time"))


def request_id(spark, sf_dir):
    pattern = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    tagged = cdc_log(spark, sf_dir).select(SEQ, F.uuid().alias("request_id"))
    return tagged.select(SEQ, F.col("request_id").rlike(pattern).alias("is_uuid"))


# -- predicates and checks ---------------------------------------------------------------


def table_filter_query(spark, sf_dir):
    parsed = parse_subject(cdc_log(spark, sf_dir))
    return table_filter(parsed).select(SEQ, F.col("subject_info.table_name").alias("table"))


def _with_code(code: str) -> Query:
    def query(spark, sf_dir):
        failed = C.classify(cdc_log(spark, sf_dir)).filter(F.col("error_code") == code)
        return failed.select(SEQ, "subject_table", "payload_table", "error_stage", "result")

    return query


def validate_required(spark, sf_dir):
    checked = C.classify(cdc_log(spark, sf_dir))
    required = ("empty_pk", "missing_company_id", "empty_agent_id", "missing_chat_id")
    return checked.filter(F.size("type_errors") == 0).select(
        SEQ, "payload_table", F.when(F.col("error_code").isin(*required), F.col("error_code")).alias("failed")
    )


def type_errors(spark, sf_dir):
    found = C.classify(cdc_log(spark, sf_dir)).filter(F.size("type_errors") > 0)
    return found.select(SEQ, "payload_table", _joined("type_errors"))


def with_whole(rejected: DataFrame, log: DataFrame) -> DataFrame:
    """Whether the kept body is the one that was captured, and its first bytes' number."""
    sent = log.select(SEQ, F.col("data").alias("_sent")).distinct()
    return rejected.join(sent, SEQ).select(
        SEQ,
        "result",
        "error_code",
        F.length("preview").alias("preview_bytes"),
        F.col("body").eqNullSafe(F.col("_sent")).alias("whole"),
    )


def quarantine(spark, sf_dir):
    log = cdc_log(spark, sf_dir)
    return with_whole(C.quarantine(log), log)


# -- row images -------------------------------------------------------------------------------


def _typed(spark, sf_dir, spec: TableSpec) -> DataFrame:
    rows = _decoded(spark, sf_dir).filter(F.col("payload_table") == spec.name)
    return rows.select(SEQ, *R.typed_columns(F.col("record"), spec))


def typed_agents(spark, sf_dir):
    return _typed(spark, sf_dir, AGENTS).select(
        SEQ, "id", "agent_id", "company_id", "status", "host_name", _micros("created_at", "created_us")
    )


def typed_chats(spark, sf_dir):
    return _typed(spark, sf_dir, CHATS).select(
        SEQ,
        "id",
        "chat_id",
        "agent_id",
        "company_id",
        "is_group",
        F.col("unread_count").cast("bigint").alias("unread_count"),
        F.try_variant_get("last_message", "$.k", "bigint").alias("last_message_k"),
    )


def typed_messages(spark, sf_dir):
    return _typed(spark, sf_dir, MESSAGES).select(
        SEQ,
        "id",
        "message_id",
        "chat_id",
        "agent_id",
        "company_id",
        "flow",
        "is_deleted",
        "message_timestamp",
        R.format_date(F.col("message_date")).alias("message_date"),
        F.try_variant_get("message_obj", "$.k", "bigint").alias("message_obj_k"),
    )


def typed_contacts(spark, sf_dir):
    return _typed(spark, sf_dir, CONTACTS).select(
        SEQ, "id", "phone_number", "company_id", "agent_id", "custom_name"
    )


def _message_texts(spark, sf_dir):
    """Two texts per decodable message: its date, and its commit time, which is none."""
    log = decode_envelope(cdc_log(spark, sf_dir)).filter(F.col("table_name") == "messages")
    dated = log.filter(F.col("record").isNotNull())
    return dated.select(
        SEQ,
        R.field(F.col("record"), "message_date", "string").alias("date_text"),
        F.col("commit_timestamp").alias("time_text"),
    )


def custom_date_parse(spark, sf_dir):
    texts = _message_texts(spark, sf_dir)
    return texts.select(
        SEQ,
        R.parse_date(F.col("date_text")).cast("string").alias("parsed"),
        R.bad_date(F.col("date_text")).alias("bad"),
        R.parse_date(F.col("time_text")).isNull().alias("time_is_no_date"),
        R.bad_date(F.col("time_text")).alias("time_bad"),
    )


def custom_date_format(spark, sf_dir):
    parsed = _message_texts(spark, sf_dir).select(SEQ, R.parse_date(F.col("date_text")).alias("d"))
    shown = F.to_json(F.struct(R.format_date(F.col("d")).alias("message_date")), {"ignoreNullFields": "false"})
    return parsed.select(SEQ, shown.alias("json"))


def unhandled_fields(spark, sf_dir):
    return _decoded(spark, sf_dir).select(SEQ, "payload_table", _joined("unhandled_fields"))


def known_fields_query(spark, sf_dir):
    """The catalogue with the number of rows that carry each field."""
    carried = (
        _decoded(spark, sf_dir)
        .select(F.col("payload_table").alias("table"), F.explode(F.map_keys("record")).alias("field"))
        .groupBy("table", "field")
        .agg(F.count("*").alias("n"))
    )
    catalogue = known_fields(spark)
    return catalogue.join(carried, ["table", "field"], "left").select(
        "table",
        F.col("position").cast("bigint").alias("position"),
        "field",
        "type",
        F.coalesce("n", F.lit(0)).alias("rows_with_field"),
    )


def extract_pk(spark, sf_dir):
    return _decoded(spark, sf_dir).select(SEQ, "payload_table", "pk")


def event_id(spark, sf_dir):
    return _routable(spark, sf_dir).select(SEQ, "event_id")


def event_id_table(spark, sf_dir):
    split = _routable(spark, sf_dir).select(
        SEQ,
        R.event_id_table(F.col("event_id")).alias("table"),
        R.event_id_table(F.col("pk")).alias("table_of_pk"),
    )
    return split


def dedup_key(spark, sf_dir):
    return _routable(spark, sf_dir).select(SEQ, R.dedup_key(F.col("event_id")).alias("dedup_key"))


def routing_ids(spark, sf_dir):
    return _decoded(spark, sf_dir).select(
        SEQ, "payload_table", "company_id", "agent_id", "chat_id", "message_id"
    )


def target_subject(spark, sf_dir):
    return _routable(spark, sf_dir).select(SEQ, "target_subject")


def enriched_event(spark, sf_dir):
    events = E.enriched(_routable(spark, sf_dir), stamp="received_at")
    return events.select(
        SEQ,
        "event_id",
        "event_time",
        "company_id",
        "agent_id",
        "chat_id",
        "message_id",
        F.size(F.json_object_keys(F.to_json("row_data"))).cast("bigint").alias("row_fields"),
    )


def payload_json(spark, sf_dir):
    """The JSON event, read back: its keys, the row's keys and some values."""
    p = F.col("payload")

    def keys(json: Column) -> Column:
        return F.array_join(F.sort_array(F.json_object_keys(json)), ",")

    return E.enriched(_routable(spark, sf_dir), stamp="received_at").select(
        SEQ,
        keys(p).alias("event_keys"),
        keys(F.get_json_object(p, "$.row_data")).alias("row_keys"),
        F.get_json_object(p, "$.event_id").alias("event_id"),
        F.get_json_object(p, "$.event_time").alias("event_time"),
        F.get_json_object(p, "$.chat_id").alias("chat_id"),
        F.get_json_object(p, "$.row_data.id").alias("row_id"),
        F.get_json_object(p, "$.row_data.extra.k").alias("row_extra_k"),
        F.get_json_object(p, "$.row_data.text").alias("row_text"),
    )


# -- outcomes ---------------------------------------------------------------------------------


def outcomes_query(spark, sf_dir):
    kept = (
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
    )
    out = _outcomes(spark, sf_dir, SEQ, "received_at", *kept, "unhandled_fields")
    return out.select(SEQ, _micros("received_at", "received_us"), *kept, _joined("unhandled_fields"))


def error_details(spark, sf_dir):
    failed = C.classify(cdc_log(spark, sf_dir)).filter(F.col("result") == C.DATA_ERROR)
    return failed.select(SEQ, "error_stage", "error_table", "error_code")


def dispositions(spark, sf_dir):
    out = _outcomes(spark, sf_dir, "result", "disposition")
    return out.groupBy("result", "disposition").agg(F.count("*").alias("n"))


# -- metrics ----------------------------------------------------------------------------------


def _counter(fn) -> Query:
    return lambda spark, sf_dir: fn(M.counter_base(_outcomes(spark, sf_dir, *M.READ)))


def events_published_total(spark, sf_dir):
    return M.events_published_total(_outcomes(spark, sf_dir, *M.READ))


def processing_histogram(spark, sf_dir):
    return M.processing_histogram(_outcomes(spark, sf_dir, *M.READ))


def consumer_lag(spark, sf_dir):
    return M.consumer_lag(_outcomes(spark, sf_dir, *M.READ))


def unhandled_fields_total(spark, sf_dir):
    return M.unhandled_fields_total(C.classify(cdc_log(spark, sf_dir)))


def metrics_snapshot(spark, sf_dir):
    snapshot = M.metrics_snapshot(materialize(_outcomes(spark, sf_dir, *M.READ), "outcomes"))
    return snapshot.select("metric", M.label_text(F.col("labels")).alias("labels"), "value")


def metric_lookup(spark, sf_dir):
    snapshot = M.metrics_snapshot(materialize(_outcomes(spark, sf_dir, *M.READ), "outcomes"))
    found = M.metric_lookup(snapshot, M.EVENTS_TOTAL, {"table": "messages", "result": "processed"})
    absent = M.metric_lookup(snapshot, M.EVENTS_TOTAL, {"table": "messages"})
    return found.unionByName(absent).select("metric", M.label_text(F.col("labels")).alias("labels"), "value")


def slo_report(spark, sf_dir):
    report = M.slo_report(_outcomes(spark, sf_dir, "result", "received_at", "acked_at"), window="1 day", latency_target_s=2.0)
    return report.select(
        _micros("window_start", "window_start_us"),
        "events",
        F.round("events_per_s", 6).alias("events_per_s"),
        F.round("p95_latency_s", 6).alias("p95_latency_s"),
        "latency_met",
        "throughput_met",
    )


# -- deduplication and reliability --------------------------------------------------------------


def _keys(spark, sf_dir) -> DataFrame:
    """Published deliveries' keys, written once for the passes of deduplication."""
    routable = _routable(spark, sf_dir).filter("sink_ok AND dedup_ok")
    return materialize(routable.select("event_id", "received_at", SEQ), "keys")


def dedup_ttl(spark, sf_dir):
    accepted = D.accepted_deliveries(_keys(spark, sf_dir))
    return accepted.select("event_id", _micros("received_at", "received_us"), SEQ)


def dedup_first(spark, sf_dir):
    return D.first_deliveries(_keys(spark, sf_dir)).select("event_id", SEQ)


def dedup_hot_key(spark, sf_dir):
    """Accepted arrivals where one key has a third of them: long chains."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    hot = F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("user_id")))
    rows = events.select(
        hot.alias("event_id"), F.col("ts").cast("timestamp").alias("received_at"), F.col("event_id").alias(SEQ)
    )
    return D.accepted_deliveries(rows).select("event_id", _micros("received_at", "received_us"), SEQ)


def dedup_flags(spark, sf_dir):
    return D.flag_deliveries(_keys(spark, sf_dir)).select("event_id", SEQ, "dedup")


def failure_guard(spark, sf_dir):
    runs = G.failure_guard(_outcomes(spark, sf_dir, "consumer_id", SEQ, "acked_at", "result"), threshold_seconds=60)
    return runs.select(
        "consumer_id",
        _micros("first_failure", "first_us"),
        _micros("last_failure", "last_us"),
        "failures",
        "breached",
    )


def _delivery_log(spark, sf_dir) -> DataFrame:
    message = F.floor(F.col(SEQ) / 10).alias("message")
    out = _outcomes(spark, sf_dir, SEQ, "received_at", "disposition")
    return out.select(message, SEQ, "received_at", "disposition")


def redelivery_status(spark, sf_dir):
    status = G.redelivery_status(_delivery_log(spark, sf_dir))
    return status.select(
        "message",
        "attempts",
        _micros("first_delivered_at", "first_us"),
        _micros("last_delivered_at", "last_us"),
        "last_disposition",
        "status",
        _micros("next_delivery_at", "next_us"),
    )


def redelivery_schedule(spark, sf_dir):
    refused = _delivery_log(spark, sf_dir).filter("disposition = 'nack'")
    plan = G.redelivery_schedule(refused)
    return plan.select(SEQ, F.col("attempt").cast("bigint").alias("attempt"), _micros("due_at", "due_us"))


# -- end to end ------------------------------------------------------------------------------------


def _published(spark, sf_dir, tables=DEFAULT_TABLES) -> DataFrame:
    return E.published(outcomes(cdc_log(spark, sf_dir), tables), stamp="received_at")


_EVENT = ("event_id", "event_time", "company_id", "agent_id", "chat_id", "message_id", "target_subject")


def published_events(spark, sf_dir):
    events = _published(spark, sf_dir)
    return events.select(*_EVENT, SEQ, F.get_json_object("payload", "$.row_data.id").alias("row_id"))


def published_by_table(spark, sf_dir):
    return _published(spark, sf_dir).groupBy("logical").agg(
        F.count("*").alias("events"),
        F.count_distinct("event_id").alias("event_ids"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
    )


def fanout_select(spark, sf_dir):
    """One company's messages and another's agents, read from the written layout."""
    path = f"{shared_dir(spark)}/rowtide/layout-{uuid.uuid4().hex}"
    write_routed(_published(spark, sf_dir), path)
    wanted = "websocket.company_1.*.messages.>, websocket.company_2.*.agents"
    return read_routed(spark, path, wanted).select("event_id", SEQ, "target_subject")


def subscriptions(spark, sf_dir):
    """Who hears which event: a subscriber per agent, per company and table, and one for all chats."""
    users = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").distinct()
    company, user = (F.col("user_id") % 10).cast("string"), F.col("user_id").cast("string")

    def named(subscriber: Column, *pattern: Column | str) -> DataFrame:
        parts = [F.lit(p) if isinstance(p, str) else p for p in pattern]
        return users.select(subscriber.alias("subscriber"), F.concat(*parts).alias("pattern")).distinct()

    table = named(F.concat(F.lit("agent "), user), "websocket.company_", company, ".agent_", user, ".>")
    table = table.unionByName(named(F.concat(F.lit("company "), company), "websocket.company_", company, ".*.agents"))
    table = table.unionByName(named(F.lit("chats"), "*.*.*.chats"))
    heard = matching_subscribers(_published(spark, sf_dir).select("event_id", SEQ, "target_subject"), table)
    return heard.select("subscriber", "event_id", SEQ)


USER_PROFILES = TableSpec(
    name="user_profiles",
    pk="agent_id",
    fields={"id": "long", "agent_id": "string", "company_id": "string", "text": "string"},
)


def custom_table_spec(spark, sf_dir):
    events = _published(spark, sf_dir, (*DEFAULT_TABLES, USER_PROFILES))
    return events.filter(F.col("logical") == USER_PROFILES.name).select(*_EVENT, SEQ)


QUERIES: dict[str, Query] = {
    "cdc_scan": cdc_scan,
    "subject_pattern_filter": subject_pattern_filter,
    "parse_subject": parse_subject_query,
    "events_by_action": events_by_action,
    "decode_envelope": decode_envelope_query,
    "authoritative_table": authoritative_table,
    "table_mismatch": table_mismatch,
    "event_time_rfc3339": event_time_rfc3339,
    "request_id": request_id,
    "table_filter": table_filter_query,
    "unknown_table": _with_code("unknown_table"),
    "null_record": _with_code("null_record"),
    "validate_required": validate_required,
    "type_errors": type_errors,
    "quarantine": quarantine,
    "typed_agents": typed_agents,
    "typed_chats": typed_chats,
    "typed_messages": typed_messages,
    "typed_contacts": typed_contacts,
    "custom_date_parse": custom_date_parse,
    "custom_date_format": custom_date_format,
    "unhandled_fields": unhandled_fields,
    "known_fields": known_fields_query,
    "extract_pk": extract_pk,
    "event_id": event_id,
    "event_id_table": event_id_table,
    "dedup_key": dedup_key,
    "routing_ids": routing_ids,
    "target_subject": target_subject,
    "enriched_event": enriched_event,
    "payload_json": payload_json,
    "outcomes": outcomes_query,
    "error_details": error_details,
    "dispositions": dispositions,
    "events_total": _counter(M.events_total),
    "publish_errors_total": _counter(M.publish_errors_total),
    "events_published_total": events_published_total,
    "dedup_cache_hits": _counter(M.dedup_cache_hits),
    "dedup_checks_total": _counter(M.dedup_checks_total),
    "processing_histogram": processing_histogram,
    "consumer_lag": consumer_lag,
    "unhandled_fields_total": unhandled_fields_total,
    "metrics_snapshot": metrics_snapshot,
    "metric_lookup": metric_lookup,
    "slo_report": slo_report,
    "dedup_ttl": dedup_ttl,
    "dedup_first": dedup_first,
    "dedup_flags": dedup_flags,
    "dedup_hot_key": dedup_hot_key,
    "failure_guard": failure_guard,
    "redelivery_status": redelivery_status,
    "redelivery_schedule": redelivery_schedule,
    "published_events": published_events,
    "published_by_table": published_by_table,
    "fanout_select": fanout_select,
    "subscriptions": subscriptions,
    "custom_table_spec": custom_table_spec,
}
