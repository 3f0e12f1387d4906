"""The same questions as SQL for DuckDB, answered from the base table's columns.

Nothing here reads the change log's JSON: which rows fail which check follows
from the event id, so a misreading of the JSON cannot hide on both sides.
Deduplication is a recursive walk over each event's deliveries.
"""

from __future__ import annotations

_TABLES = ("messages", "chats", "agents", "contacts")


def _with(tables: tuple[str, ...] = _TABLES) -> str:
    allowed = ", ".join(f"'{t}'" for t in tables)
    return f"""
WITH RECURSIVE e AS (
  SELECT event_id AS x, user_id, value, ts, epoch_us(ts) AS us,
         regexp_extract(props, '([0-9]+)', 1) AS k,
         CASE event_type WHEN 'click' THEN 'messages' WHEN 'view' THEN 'chats'
           WHEN 'purchase' THEN 'contacts' WHEN 'signup' THEN 'agents'
           ELSE CASE WHEN event_id % 2 = 0 THEN 'user_profiles' ELSE 'orders' END END AS st
  FROM events),
m AS (
  SELECT *, CASE WHEN x % 107 = 3 THEN '' WHEN x % 109 = 2 THEN 'unknown_table'
    WHEN x % 53 = 12 THEN CASE st WHEN 'messages' THEN 'chats' WHEN 'chats' THEN 'contacts'
      WHEN 'contacts' THEN 'agents' WHEN 'agents' THEN 'messages' ELSE st END
    ELSE st END AS mt FROM e),
s AS (
  SELECT *, CASE WHEN mt IN ('', 'unknown_table') THEN st ELSE mt END AS shape,
    CASE WHEN x % 20 = 0 THEN 'delete' WHEN x % 20 BETWEEN 1 AND 4 THEN 'update' ELSE 'insert' END AS act,
    (x % 101 = 7 OR x % 199 = 11 OR x % 197 = 13) AS bad_subject,
    (x % 103 = 5) AS short,
    (x % 103 = 5 OR x % 307 = 20 OR x % 311 = 21 OR x % 313 = 22
      OR x % 317 = 23 OR x % 331 = 24) AS cut FROM m),
c AS (
  SELECT *,
    CASE WHEN x % 59 = 8 THEN NULL ELSE 'company_' || (user_id % 10) END AS company,
    CASE WHEN shape = 'agents' AND x % 67 = 6 THEN NULL
      WHEN x % 71 = 9 THEN '' ELSE 'agent_' || user_id END AS agent,
    CASE WHEN shape NOT IN ('messages', 'chats') THEN NULL
      WHEN x % 73 = 10 OR (shape = 'chats' AND x % 67 = 6) THEN NULL
      ELSE 'chat_' || (x % 500) END AS chat,
    CASE WHEN shape = 'messages' AND x % 67 <> 6 THEN 'msg_' || x END AS message,
    CASE WHEN shape = 'contacts' AND x % 67 <> 6 THEN 'contact_' || x END AS contact,
    CASE WHEN shape = 'messages' AND x % 17 <> 0 AND x % 19 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS mdate,
    list_filter([
      CASE WHEN shape <> 'contacts' OR x % 67 <> 6 OR x % 61 = 4 THEN 'id' END,
      CASE WHEN shape = 'messages' AND x % 67 <> 6 THEN 'message_id' END,
      CASE WHEN shape IN ('messages', 'chats') AND x % 73 <> 10
             AND NOT (shape = 'chats' AND x % 67 = 6) THEN 'chat_id' END,
      CASE WHEN NOT (shape = 'agents' AND x % 67 = 6) THEN 'agent_id' END,
      'company_id',
      CASE WHEN shape = 'messages' THEN 'message_obj' END,
      CASE WHEN shape = 'messages' THEN 'message_timestamp' END,
      CASE WHEN shape = 'messages' THEN 'message_date' END,
      CASE WHEN shape = 'messages' THEN 'flow' END,
      CASE WHEN shape = 'messages' THEN 'is_deleted' END,
      CASE WHEN shape = 'chats' THEN 'is_group' END,
      CASE WHEN shape = 'chats' THEN 'unread_count' END,
      CASE WHEN shape = 'chats' THEN 'last_message' END,
      CASE WHEN shape = 'agents' THEN 'status' END,
      CASE WHEN shape = 'agents' THEN 'created_at' END,
      CASE WHEN shape = 'contacts' THEN 'phone_number' END,
      CASE WHEN x % 7 = 0 THEN 'text' END,
      CASE WHEN x % 11 = 0 THEN 'last_metadata' END,
      CASE WHEN x % 13 = 0 THEN 'extra' END], lambda v: v IS NOT NULL) AS row_keys,
    list_filter([CASE WHEN x % 13 = 0 THEN 'extra' END, CASE WHEN x % 11 = 0 THEN 'last_metadata' END,
      CASE WHEN x % 7 = 0 AND mt <> 'user_profiles' THEN 'text' END], lambda v: v IS NOT NULL) AS drift
  FROM s),
p AS (
  SELECT *, CASE mt WHEN 'messages' THEN message WHEN 'chats' THEN chat WHEN 'agents' THEN agent
      WHEN 'contacts' THEN contact WHEN 'user_profiles' THEN agent END AS pk,
    concat_ws('.', CASE WHEN x % 199 = 11 THEN 'other.changes' ELSE 'sequin.changes' END, 'appdb', 'public',
      CASE WHEN x % 197 = 13 THEN '' ELSE st END, CASE WHEN x % 101 <> 7 THEN act END) AS subject
  FROM c),
q AS (
  SELECT *, CASE
    WHEN bad_subject THEN 1
    WHEN st NOT IN ({allowed}) THEN 2
    WHEN cut THEN 3
    WHEN mt = '' THEN 4
    WHEN mt NOT IN ({allowed}) THEN 5
    WHEN x % 113 = 1 THEN 6
    WHEN x % 61 = 4 OR (x % 127 = 30 AND shape <> 'contacts') THEN 7
    WHEN coalesce(pk, '') = '' THEN 8
    WHEN coalesce(company, '') = '' THEN 9
    WHEN coalesce(agent, '') = '' THEN 10
    WHEN mt = 'messages' AND coalesce(chat, '') = '' THEN 11
    WHEN x % 401 = 33 THEN 12
    ELSE 0 END AS step FROM p),
d AS (
  SELECT q.*, v.n, v.cp, x * 10 + v.n AS seq, CASE WHEN x % 401 <> 33 THEN us + v.off * 1000000 END AS rus,
    'c' || (user_id % 4) AS consumer, value / 100 AS dur,
    CASE WHEN x % 401 <> 33 THEN us + v.off * 1000000 + CAST(round(value / 100 * 1000000) AS BIGINT) END AS aus,
    NOT (v.n = 0 AND x % 47 = 14) AS sink_ok, NOT (v.n = 0 AND x % 43 = 15) AS lookup_ok,
    CASE WHEN x % 401 <> 33 THEN strftime(make_timestamp(us + v.off * 1000000), '%Y-%m-%dT%H:%M:%SZ') END AS etime,
    CASE WHEN step = 0 THEN (1000000 + x) || ':' || mt || ':' || pk END AS eid,
    CASE WHEN step = 0 THEN 'websocket.' || company || '.' || agent || '.' || mt
      || CASE WHEN mt = 'messages' THEN '.' || chat ELSE '' END END AS target
  FROM q CROSS JOIN (VALUES (0, 0, 0), (0, 0, 1), (1, 60, 0), (2, 400, 0), (3, 500, 0), (4, 300, 0)) v(n, off, cp)
  WHERE (v.n = 0 AND v.cp = 0) OR (v.cp = 1 AND x % 35 = 1) OR (v.n = 1 AND x % 10 = 0) OR (v.n = 2 AND x % 15 = 0)
     OR (v.n = 3 AND x % 45 = 0) OR (v.n = 4 AND x % 50 = 0)),
o AS (
  SELECT x, seq, cp, rus, sink_ok, row_number() OVER (PARTITION BY x ORDER BY rus, seq, cp) AS rn
  FROM d WHERE step = 0 AND lookup_ok),
f AS (
  SELECT x, seq, cp, rn, CASE WHEN sink_ok THEN rus END AS anchor, 'miss' AS dedup FROM o WHERE rn = 1
  UNION ALL
  SELECT o.x, o.seq, o.cp, o.rn,
    CASE WHEN o.rus < f.anchor + 300000000 THEN f.anchor WHEN o.sink_ok THEN o.rus ELSE f.anchor END,
    CASE WHEN o.rus < f.anchor + 300000000 THEN 'hit' ELSE 'miss' END
  FROM f JOIN o ON o.x = f.x AND o.rn = f.rn + 1),
r AS (
  SELECT d.*, f.dedup,
    CASE step WHEN 1 THEN 'error' WHEN 2 THEN 'skipped' WHEN 3 THEN 'unmarshal_error'
      WHEN 0 THEN CASE WHEN NOT d.lookup_ok THEN 'dedup_error' WHEN f.dedup = 'hit' THEN 'duplicate' WHEN NOT d.sink_ok THEN 'publish_error'
        ELSE 'processed' END
      ELSE 'transform_data_error' END AS result,
    CASE WHEN bad_subject THEN 'unknown_subject_format' ELSE st END AS rtable,
    CASE WHEN NOT bad_subject THEN st END AS stable,
    CASE WHEN step IN (1, 2, 3) THEN NULL ELSE mt END AS ptable,
    CASE step WHEN 1 THEN 'invalid_subject' WHEN 2 THEN 'table_not_allowed' WHEN 3 THEN 'undecodable'
      WHEN 4 THEN 'empty_table_name' WHEN 5 THEN 'unknown_table' WHEN 6 THEN 'null_record'
      WHEN 7 THEN 'type_mismatch' WHEN 8 THEN 'empty_pk' WHEN 9 THEN 'missing_company_id'
      WHEN 10 THEN 'empty_agent_id' WHEN 11 THEN 'missing_chat_id' WHEN 12 THEN 'missing_arrival_time' END AS code,
    CASE step WHEN 4 THEN 'empty_metadata_table_name' WHEN 6 THEN 'populate_typed_data'
      WHEN 7 THEN 'unmarshal_to_typed_data' WHEN 8 THEN 'extract_pk' END AS stage,
    CASE WHEN step = 0 OR step >= 8 THEN array_to_string(drift, ',') END AS drift_text
  FROM d LEFT JOIN f ON f.seq = d.seq AND f.cp = d.cp),
z AS (
  SELECT *, CASE WHEN result IN ('publish_error', 'dedup_error') THEN 'nack' ELSE 'ack' END AS disp FROM r)
"""


_W = _with()
_FITS = "(step = 0 OR step >= 8)"
_EVENT = """eid AS event_id, etime AS event_time, company AS company_id, agent AS agent_id,
  CASE WHEN mt IN ('messages', 'chats') THEN coalesce(chat, '') ELSE '' END AS chat_id,
  CASE WHEN mt = 'messages' THEN message ELSE '' END AS message_id"""
_EVENTS_TOTAL = """
  SELECT "table", result, count(*) AS value FROM (
    SELECT rtable AS "table", result FROM z
    UNION ALL
    SELECT mt, CASE WHEN step = 8 THEN 'pk_extraction_error' ELSE 'typed_data_population_error' END
    FROM z WHERE step IN (6, 7, 8)) GROUP BY ALL"""
_PUBLISHED_TOTAL = """
  SELECT target AS subject, CASE result WHEN 'processed' THEN 'success' ELSE 'failure' END AS status,
    count(*) AS value
  FROM z WHERE result IN ('processed', 'publish_error') GROUP BY ALL"""
_HITS = "SELECT dedup AS status, count(*) AS value FROM z WHERE dedup IS NOT NULL GROUP BY ALL"
_CHECKS = """
  SELECT mt AS "table", dedup AS result, count(*) AS value FROM z WHERE dedup IS NOT NULL GROUP BY ALL"""
_DRIFT = f"""
  SELECT mt AS "table", field, count(*) AS value FROM (
    SELECT mt, unnest(drift) AS field FROM z WHERE {_FITS}) GROUP BY ALL"""
_HISTOGRAM = """
  SELECT st AS "table", b.le, count(*) FILTER (WHERE dur <= b.bound) AS bucket_count,
    CAST(sum(CAST(dur AS DECIMAL(28, 9))) AS DOUBLE) AS sum_seconds, count(*) AS total_count
  FROM z CROSS JOIN (VALUES ('0.005', 0.005), ('0.01', 0.01), ('0.025', 0.025), ('0.05', 0.05), ('0.1', 0.1),
    ('0.25', 0.25), ('0.5', 0.5), ('1', 1.0), ('2.5', 2.5), ('5', 5.0), ('10', 10.0),
    ('+Inf', 'infinity'::DOUBLE)) b(le, bound)
  WHERE result = 'processed' GROUP BY ALL"""
_LAG = """
  SELECT consumer AS consumer_id, max(aus - rus) / 1000000 AS lag_seconds
  FROM z WHERE disp = 'ack' GROUP BY ALL"""
_SNAPSHOT = f"""
  SELECT 'cdc_consumer_events_total' AS metric, 'result=' || result || ',table=' || "table" AS labels,
    CAST(value AS DOUBLE) AS value FROM ({_EVENTS_TOTAL})
  UNION ALL SELECT 'cdc_consumer_publish_errors_total', '', CAST(count(*) FILTER (
    WHERE result = 'publish_error') AS DOUBLE) FROM z
  UNION ALL SELECT 'cdc_consumer_events_published_total', 'status=' || status || ',subject=' || subject,
    value FROM ({_PUBLISHED_TOTAL})
  UNION ALL SELECT 'cdc_consumer_redis_hit_total', 'status=' || status, value FROM ({_HITS})
  UNION ALL SELECT 'cdc_consumer_deduplication_checks_total', 'result=' || result || ',table=' || "table",
    value FROM ({_CHECKS})
  UNION ALL SELECT 'cdc_consumer_unhandled_fields_total', 'field_name=' || field || ',table=' || "table",
    value FROM ({_DRIFT})
  UNION ALL SELECT 'cdc_consumer_processing_seconds_bucket', 'le=' || le || ',table=' || "table",
    bucket_count FROM ({_HISTOGRAM})
  UNION ALL SELECT 'cdc_consumer_processing_seconds_sum', 'table=' || "table", sum_seconds
    FROM ({_HISTOGRAM}) WHERE le = '+Inf'
  UNION ALL SELECT 'cdc_consumer_processing_seconds_count', 'table=' || "table", total_count
    FROM ({_HISTOGRAM}) WHERE le = '+Inf'
  UNION ALL SELECT 'cdc_consumer_lag_seconds', 'consumer=' || consumer_id, lag_seconds FROM ({_LAG})"""
_KNOWN = """
  SELECT * FROM (VALUES
    ('agents', 'id,agent_id,company_id,qr_code,status,agent_name,host_name,version,created_at,updated_at',
     'bigint,string,string,string,string,string,string,string,timestamp,timestamp'),
    ('chats', 'id,chat_id,agent_id,company_id,jid,custom_name,push_name,is_group,group_name,unread_count,assigned_to,last_message,conversation_timestamp,phone_number',
     'bigint,string,string,string,string,string,string,boolean,string,int,string,variant,bigint,string'),
    ('messages', 'id,message_id,chat_id,agent_id,company_id,from_user,to_user,jid,flow,type,message_obj,edited_message_obj,key,status,is_deleted,message_timestamp,message_date',
     'bigint,string,string,string,string,string,string,string,string,string,variant,variant,variant,string,boolean,bigint,date'),
    ('contacts', 'id,phone_number,company_id,agent_id,custom_name,assigned_to',
     'string,string,string,string,string,string')) k("table", names, types)"""


def _code(step: int) -> str:
    return f"""{_W} SELECT seq AS stream_seq, stable AS subject_table, ptable AS payload_table,
      stage AS error_stage, result FROM z WHERE step = {step}"""


def _published(cols: str, tables: tuple[str, ...] = _TABLES, where: str = "") -> str:
    return f"{_with(tables)} SELECT {cols} FROM z WHERE result = 'processed' {where}"


ORACLE: dict[str, str] = {
    "cdc_scan": f"""{_W} SELECT seq AS stream_seq, subject, rus AS received_us, consumer AS consumer_id,
        sink_ok, lookup_ok AS dedup_ok, dur AS duration_s FROM d""",
    "subject_pattern_filter": f"""{_W} SELECT seq AS stream_seq, subject FROM d
        WHERE st IN ('messages', 'agents') AND NOT bad_subject""",
    "parse_subject": f"""{_W} SELECT seq AS stream_seq, subject AS raw,
        CASE WHEN x % 101 = 7 THEN '' WHEN x % 199 = 11 THEN 'other.changes' ELSE 'sequin.changes' END AS prefix,
        CASE WHEN x % 101 = 7 OR x % 199 = 11 THEN '' ELSE 'appdb' END AS database_name,
        CASE WHEN x % 101 = 7 OR x % 199 = 11 THEN '' ELSE 'public' END AS schema_name,
        CASE WHEN bad_subject THEN '' ELSE st END AS table_name,
        CASE WHEN x % 101 = 7 OR x % 199 = 11 THEN '' ELSE act END AS action,
        NOT bad_subject AS is_valid FROM d""",
    "events_by_action": f"""{_W} SELECT act AS action, count(*) AS n FROM d WHERE NOT bad_subject GROUP BY ALL""",
    "decode_envelope": f"""{_W} SELECT seq AS stream_seq, NOT cut AS decodable,
        CASE WHEN NOT cut THEN act END AS action, CASE WHEN NOT cut THEN 'public' END AS table_schema,
        CASE WHEN NOT cut THEN mt END AS table_name, CASE WHEN NOT cut THEN 1000000 + x END AS commit_lsn,
        (NOT cut AND x % 113 <> 1) AS has_record FROM d""",
    "authoritative_table": f"""{_W} SELECT seq AS stream_seq, st AS subject_table, nullif(mt, '') AS "table",
        CASE WHEN mt = '' THEN 'empty_metadata_table_name' END AS error_stage
        FROM z WHERE step NOT IN (1, 2, 3)""",
    "table_mismatch": f"""{_W} SELECT st AS subject_table, mt AS payload_table, st <> mt AS mismatch,
        count(*) AS n FROM z WHERE step NOT IN (1, 2, 3) GROUP BY ALL""",
    "event_time_rfc3339": f"{_W} SELECT seq AS stream_seq, etime AS event_time FROM d",
    "request_id": f"{_W} SELECT seq AS stream_seq, true AS is_uuid FROM d",
    "table_filter": f"""{_W} SELECT seq AS stream_seq, st AS "table" FROM z WHERE step NOT IN (1, 2)""",
    "unknown_table": _code(5),
    "null_record": _code(6),
    "validate_required": f"""{_W} SELECT seq AS stream_seq, mt AS payload_table,
        CASE WHEN step BETWEEN 8 AND 11 THEN code END AS failed FROM z WHERE {_FITS}""",
    "type_errors": f"""{_W} SELECT seq AS stream_seq, mt AS payload_table, 'id' AS type_errors
        FROM z WHERE step = 7""",
    "quarantine": f"""{_W} SELECT seq AS stream_seq, result, code AS error_code,
        CASE WHEN short THEN 20 ELSE 64 END AS preview_bytes, true AS whole FROM z WHERE step <> 0 AND step <> 2""",
    "typed_agents": f"""{_W} SELECT seq AS stream_seq, x AS id, agent AS agent_id, company AS company_id,
        CASE WHEN x % 2 = 0 THEN 'online' ELSE 'offline' END AS status, CAST(NULL AS VARCHAR) AS host_name,
        epoch_us(date_trunc('second', ts)) AS created_us FROM z WHERE mt = 'agents' AND {_FITS}""",
    "typed_chats": f"""{_W} SELECT seq AS stream_seq, x AS id, chat AS chat_id, agent AS agent_id,
        company AS company_id, x % 3 = 0 AS is_group, x % 50 AS unread_count,
        CAST(k AS BIGINT) AS last_message_k FROM z WHERE mt = 'chats' AND {_FITS}""",
    "typed_messages": f"""{_W} SELECT seq AS stream_seq, x AS id, message AS message_id, chat AS chat_id,
        agent AS agent_id, company AS company_id,
        CASE WHEN x % 2 = 0 THEN 'inbound' ELSE 'outbound' END AS flow, false AS is_deleted,
        us // 1000 AS message_timestamp, mdate AS message_date, CAST(k AS BIGINT) AS message_obj_k
        FROM z WHERE mt = 'messages' AND {_FITS}""",
    "typed_contacts": f"""{_W} SELECT seq AS stream_seq, contact AS id, CAST(user_id AS VARCHAR) AS phone_number,
        company AS company_id, agent AS agent_id, CAST(NULL AS VARCHAR) AS custom_name
        FROM z WHERE mt = 'contacts' AND {_FITS}""",
    "custom_date_parse": f"""{_W} SELECT seq AS stream_seq, mdate AS parsed, false AS bad,
        true AS time_is_no_date, true AS time_bad
        FROM d WHERE mt = 'messages' AND NOT cut AND x % 113 <> 1""",
    "custom_date_format": f"""{_W} SELECT seq AS stream_seq,
        '{{"message_date":' || coalesce('"' || mdate || '"', 'null') || '}}' AS json
        FROM d WHERE mt = 'messages' AND NOT cut AND x % 113 <> 1""",
    "unhandled_fields": f"""{_W} SELECT seq AS stream_seq, mt AS payload_table,
        drift_text AS unhandled_fields FROM z WHERE {_FITS}""",
    "known_fields": f"""{_W}, known AS (
          SELECT "table", unnest(string_split(names, ',')) AS field, unnest(string_split(types, ',')) AS type,
            generate_subscripts(string_split(names, ','), 1) - 1 AS position FROM ({_KNOWN})),
        carried AS (SELECT mt, field, count(*) AS n FROM (
          SELECT mt, unnest(row_keys) AS field FROM z WHERE {_FITS}) GROUP BY ALL)
        SELECT known."table", position, known.field, type, coalesce(n, 0) AS rows_with_field
        FROM known LEFT JOIN carried ON mt = known."table" AND carried.field = known.field""",
    "extract_pk": f"""{_W} SELECT seq AS stream_seq, mt AS payload_table, coalesce(pk, '') AS pk
        FROM z WHERE {_FITS}""",
    "event_id": f"{_W} SELECT seq AS stream_seq, eid AS event_id FROM z WHERE step = 0",
    "event_id_table": f"""{_W} SELECT seq AS stream_seq, mt AS "table", 'unknown_table' AS table_of_pk
        FROM z WHERE step = 0""",
    "dedup_key": f"{_W} SELECT seq AS stream_seq, 'dedup:' || eid AS dedup_key FROM z WHERE step = 0",
    "routing_ids": f"""{_W} SELECT seq AS stream_seq, mt AS payload_table, coalesce(company, '') AS company_id,
        coalesce(agent, '') AS agent_id,
        CASE WHEN mt IN ('messages', 'chats') THEN coalesce(chat, '') ELSE '' END AS chat_id,
        CASE WHEN mt = 'messages' THEN coalesce(message, '') ELSE '' END AS message_id
        FROM z WHERE {_FITS}""",
    "target_subject": f"{_W} SELECT seq AS stream_seq, target AS target_subject FROM z WHERE step = 0",
    "enriched_event": f"""{_W} SELECT seq AS stream_seq, {_EVENT}, len(row_keys) AS row_fields
        FROM z WHERE step = 0""",
    "payload_json": f"""{_W} SELECT seq AS stream_seq,
        'agent_id,' || CASE WHEN chat IS NOT NULL THEN 'chat_id,' ELSE '' END || 'company_id,event_id,event_time,'
          || CASE WHEN mt = 'messages' THEN 'message_id,' ELSE '' END || 'row_data' AS event_keys,
        array_to_string(list_sort(row_keys), ',') AS row_keys, eid AS event_id, etime AS event_time,
        chat AS chat_id, CASE WHEN mt = 'contacts' THEN contact ELSE CAST(x AS VARCHAR) END AS row_id,
        CASE WHEN x % 13 = 0 THEN k END AS row_extra_k, CASE WHEN x % 7 = 0 THEN 'text ' || x END AS row_text
        FROM z WHERE step = 0""",
    "outcomes": f"""{_W} SELECT seq AS stream_seq, rus AS received_us, consumer AS consumer_id,
        stable AS subject_table, ptable AS payload_table, eid AS event_id, target AS target_subject, result,
        rtable AS result_table, code AS error_code, disp AS disposition, dedup, drift_text AS unhandled_fields
        FROM z""",
    "error_details": f"""{_W} SELECT seq AS stream_seq, stage AS error_stage,
        CASE WHEN step = 4 THEN st ELSE mt END AS error_table, code AS error_code FROM z
        WHERE result = 'transform_data_error'""",
    "dispositions": f"{_W} SELECT result, disp AS disposition, count(*) AS n FROM z GROUP BY ALL",
    "events_total": f"{_W} {_EVENTS_TOTAL}",
    "publish_errors_total": f"""{_W} SELECT count(*) FILTER (WHERE result = 'publish_error') AS value FROM z""",
    "events_published_total": f"{_W} {_PUBLISHED_TOTAL}",
    "dedup_cache_hits": f"{_W} {_HITS}",
    "dedup_checks_total": f"{_W} {_CHECKS}",
    "processing_histogram": f"{_W} {_HISTOGRAM}",
    "consumer_lag": f"{_W} {_LAG}",
    "unhandled_fields_total": f"{_W} {_DRIFT}",
    "metrics_snapshot": f"{_W} {_SNAPSHOT}",
    "metric_lookup": f"""{_W} SELECT 'cdc_consumer_events_total' AS metric,
        'result=processed,table=messages' AS labels, CAST(count(*) AS DOUBLE) AS value FROM z
        WHERE result = 'processed' AND st = 'messages'""",
    "slo_report": f"""{_W} SELECT epoch_us(date_trunc('day', make_timestamp(rus))) AS window_start_us,
        count(*) AS events, round(count(*) / 86400, 6) AS events_per_s,
        round(quantile_cont((aus - rus) / 1000000, 0.95), 6) AS p95_latency_s,
        quantile_cont((aus - rus) / 1000000, 0.95) <= 2.0 AS latency_met,
        count(*) / 86400 >= 5000 AS throughput_met
        FROM z WHERE result = 'processed' GROUP BY 1""",
    "dedup_ttl": f"""{_W} SELECT eid AS event_id, rus AS received_us, seq AS stream_seq FROM z
        WHERE dedup = 'miss' AND sink_ok""",
    "dedup_first": f"""{_W} SELECT eid AS event_id, min(seq) AS stream_seq FROM (
          SELECT eid, seq, rus, min(rus) OVER (PARTITION BY eid) AS first_us FROM z
          WHERE step = 0 AND sink_ok AND lookup_ok)
        WHERE rus = first_us GROUP BY eid""",
    "dedup_flags": f"""{_W} SELECT eid AS event_id, seq AS stream_seq, dedup FROM z
        WHERE step = 0 AND sink_ok AND lookup_ok""",
    "dedup_hot_key": """
        WITH RECURSIVE a AS (
          SELECT CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE 'k' || user_id END AS k, epoch_us(ts) AS us, min(event_id) AS seq
          FROM events GROUP BY ALL),
        n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY us) AS rn FROM a),
        w AS (
          SELECT k, us, seq, rn, us AS anchor FROM n WHERE rn = 1
          UNION ALL
          SELECT n.k, n.us, n.seq, n.rn, CASE WHEN n.us >= w.anchor + 300000000 THEN n.us ELSE w.anchor END
          FROM w JOIN n ON n.k = w.k AND n.rn = w.rn + 1)
        SELECT k AS event_id, us AS received_us, seq AS stream_seq FROM w WHERE us = anchor""",
    "failure_guard": f"""{_W}, ordered AS (
          SELECT consumer, aus, result, sum(CASE WHEN result = 'processed' THEN 1 ELSE 0 END) OVER (
            PARTITION BY consumer ORDER BY aus, seq) AS island
          FROM z WHERE result IN ('processed', 'publish_error', 'dedup_error'))
        SELECT consumer AS consumer_id, min(aus) AS first_us, max(aus) AS last_us, count(*) AS failures,
          max(aus) - min(aus) > 60000000 AS breached
        FROM ordered WHERE result <> 'processed' GROUP BY consumer, island""",
    "redelivery_status": f"""{_W}, msg AS (
          SELECT x AS message, count(*) AS attempts, min(rus) AS first_us, max(rus) AS last_us,
            coalesce(arg_max(disp, rus), max(disp)) AS last_disposition, bool_or(disp = 'ack') AS acked FROM z GROUP BY x)
        SELECT message, attempts, first_us, last_us, last_disposition,
          CASE WHEN acked THEN 'acked' WHEN attempts >= 3 THEN 'exhausted' ELSE 'pending' END AS status,
          CASE WHEN NOT acked AND attempts < 3 THEN last_us + 30000000 END AS next_us FROM msg""",
    "redelivery_schedule": f"""{_W} SELECT seq AS stream_seq, a AS attempt, rus + (a - 1) * 30000000 AS due_us
        FROM z CROSS JOIN (VALUES (1), (2), (3)) t(a) WHERE disp = 'nack'""",
    "published_events": _published(
        f"""{_EVENT}, target AS target_subject, seq AS stream_seq,
        CASE WHEN mt = 'contacts' THEN contact ELSE CAST(x AS VARCHAR) END AS row_id"""
    ),
    "published_by_table": _published(
        """mt AS logical, count(*) AS events, count(DISTINCT eid) AS event_ids,
        min(etime) AS first_event, max(etime) AS last_event""",
        where="GROUP BY mt",
    ),
    "fanout_select": _published(
        "eid AS event_id, seq AS stream_seq, target AS target_subject",
        where="""AND ((company = 'company_1' AND mt = 'messages') OR (company = 'company_2' AND mt = 'agents'))""",
    ),
    "custom_table_spec": _published(
        f"{_EVENT}, target AS target_subject, seq AS stream_seq",
        tables=(*_TABLES, "user_profiles"),
        where="AND mt = 'user_profiles'",
    ),
}

ORACLE |= {
    "src_stream": f"{_W} SELECT seq AS stream_seq, subject, rus AS received_us FROM d",
    "bounded_intake": f"""{_W}, span AS (
          SELECT min(rus) AS low, (max(rus) - min(rus)) // 3 + 1 AS width FROM d)
        SELECT coalesce((rus - low) // width, 0) AS batch, count(*) AS n, min(seq) AS first_seq FROM d, span GROUP BY 1""",
    "dedup_ttl_stream": ORACLE["dedup_ttl"],
    "dedup_watermark": f"{_W} SELECT DISTINCT eid AS event_id FROM z WHERE step = 0 AND sink_ok AND lookup_ok",
    "streamed_outcomes": ORACLE["outcomes"],
    "sink_routed": _published(
        """eid AS event_id, seq AS stream_seq, company AS company_id, mt AS logical,
        target AS target_subject, etime AS event_time"""
    ),
    "quarantine_stream": ORACLE["quarantine"],
    "streamed_metrics": ORACLE["metrics_snapshot"],
}

_LAST_SENT = """
  SELECT eid, arg_max(seq, (rus, seq)) AS seq, any_value(company) AS company, any_value(mt) AS mt, any_value(target) AS target
  FROM z WHERE result = 'processed' GROUP BY eid"""

ORACLE |= {
    "dedup_state_stream": ORACLE["dedup_ttl"],
    "dedup_continued": ORACLE["dedup_ttl"],
    "upsert_events": f"""{_W} SELECT eid AS event_id, seq AS stream_seq, company AS company_id, mt AS logical,
        target AS target_subject FROM ({_LAST_SENT})""",
    "pipeline_stream": f"""{_W} SELECT 'events' AS sink, eid AS id, CAST(seq AS DOUBLE) AS value FROM ({_LAST_SENT})
        UNION ALL SELECT 'quarantine', code, count(*) FROM z WHERE step <> 0 AND step <> 2 GROUP BY code
        UNION ALL SELECT 'metrics', CASE labels WHEN '' THEN metric || '|' ELSE metric || '|' || labels END, value
        FROM ({_SNAPSHOT})""",
    "subscriptions": f"""{_W} SELECT subscriber, eid AS event_id, seq AS stream_seq FROM (
          SELECT 'agent ' || user_id AS subscriber, * FROM z WHERE result = 'processed'
          UNION ALL SELECT 'company ' || (user_id % 10), * FROM z WHERE result = 'processed' AND mt = 'agents'
          UNION ALL SELECT 'chats', * FROM z WHERE result = 'processed' AND mt = 'chats')""",
    "failure_guard_stream": ORACLE["failure_guard"],
    "redelivery_timers": f"""{_W}, t AS (
          SELECT x AS message, rus, row_number() OVER w AS attempts, lead(rus) OVER w AS following,
            max(CASE WHEN disp = 'ack' THEN 1 ELSE 0 END) OVER (
              PARTITION BY x ORDER BY rus, seq, cp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acked
          FROM z WHERE rus IS NOT NULL WINDOW w AS (PARTITION BY x ORDER BY rus, seq, cp))
        SELECT message, attempts, CASE WHEN attempts >= 3 THEN 'exhausted' ELSE 'due' END AS status,
          rus + 30000000 AS due_us
        FROM t WHERE acked = 0 AND coalesce(rus + 30000000 <= following, true)""",
    "lag_gauge": f"""{_W}, span AS (
          SELECT min(rus) AS low, (max(rus) - min(rus)) // 3 + 1 AS width FROM d),
        parts AS (SELECT consumer, (rus - low) // width AS part, max(aus - rus) AS lag FROM z, span
          WHERE disp = 'ack' AND rus IS NOT NULL GROUP BY ALL)
        SELECT consumer AS consumer_id, arg_max(lag, part) / 1000000 AS lag_seconds FROM parts GROUP BY consumer""",
}
