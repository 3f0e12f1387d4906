"""A captured change log derived from the ``events`` table.

Each event becomes a row change of one of the processed tables, or of a table
that is not processed, delivered one to five times. Fixed remainders of the
event id put every kind of defect into it: bad subjects, broken bodies, wrong
types, missing keys and times, unknown tables, failed lookups and publishing,
repeated captures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowtide.functions.settle import settled
from rowtide.session import configure

DATABASE, SCHEMA = "appdb", "public"


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def _pair(name: str, value: Column) -> Column:
    """A JSON member; NULL (left out) when the value is NULL."""
    return F.concat(F.lit(f'"{name}":'), value)


def _object(*pairs: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per change, before redelivery: ``subject``, ``data`` and keys.

    The narrow rows of ``events`` are dealt by id first: a task reads whole row
    groups, however few there are, and all that follows is a projection, which
    would run in as few tasks. The generator keeps filters on what is derived
    from an id above that exchange.
    """
    configure(spark)
    dealt = spark.read.parquet(f"{sf_dir}/events.parquet").repartition("event_id")
    events = settled(dealt, "event_id")
    x = F.col("event_id")

    def rem(m: int, r: int) -> Column:
        return x % m == r

    base = events.select(
        "event_id",
        "user_id",
        "value",
        F.col("ts").cast("timestamp").alias("ts"),
        F.regexp_extract("props", r"(\d+)", 1).alias("k"),
        F.when(F.col("event_type") == "click", "messages")
        .when(F.col("event_type") == "view", "chats")
        .when(F.col("event_type") == "purchase", "contacts")
        .when(F.col("event_type") == "signup", "agents")
        .when(x % 2 == 0, "user_profiles")
        .otherwise("orders")
        .alias("st"),
    )
    following = (
        F.when(F.col("st") == "messages", "chats")
        .when(F.col("st") == "chats", "contacts")
        .when(F.col("st") == "contacts", "agents")
        .when(F.col("st") == "agents", "messages")
        .otherwise(F.col("st"))
    )
    tabled = base.withColumn(
        "mt",
        F.when(rem(107, 3), "")
        .when(rem(109, 2), "unknown_table")
        .when(rem(53, 12), following)
        .otherwise(F.col("st")),
    ).withColumn("shape", F.when(F.col("mt").isin("", "unknown_table"), F.col("st")).otherwise(F.col("mt")))

    is_messages, is_chats = F.col("shape") == "messages", F.col("shape") == "chats"
    is_agents, is_contacts = F.col("shape") == "agents", F.col("shape") == "contacts"
    eid = x.cast("string")
    no_key = rem(67, 6)
    nested = F.concat(F.lit('{"k":'), F.col("k"), F.lit("}"))
    chat = F.when(~rem(73, 10) & ~(is_chats & no_key), _quoted(F.concat(F.lit("chat_"), (x % 500).cast("string"))))
    agent = F.when(
        ~(is_agents & no_key),
        F.when(rem(71, 9), '""').otherwise(_quoted(F.concat(F.lit("agent_"), F.col("user_id").cast("string")))),
    )
    row_id = (
        F.when(is_contacts & rem(61, 4), eid)
        .when(is_contacts, F.when(~no_key, _quoted(F.concat(F.lit("contact_"), eid))))
        .when(rem(61, 4), '"abc"')
        .when(rem(127, 30), F.concat(eid, F.lit(".0000000001")))
        .otherwise(eid)
    )
    day = F.date_format("ts", "yyyy-MM-dd")
    record = _object(
        _pair("id", row_id),
        _pair("message_id", F.when(is_messages & ~no_key, _quoted(F.concat(F.lit("msg_"), eid)))),
        _pair("chat_id", F.when(is_messages | is_chats, chat)),
        _pair("agent_id", agent),
        _pair(
            "company_id",
            F.when(rem(59, 8), "null").otherwise(
                _quoted(F.concat(F.lit("company_"), (F.col("user_id") % 10).cast("string")))
            ),
        ),
        _pair("message_obj", F.when(is_messages, nested)),
        _pair("message_timestamp", F.when(is_messages, F.unix_millis("ts").cast("string"))),
        _pair(
            "message_date",
            F.when(is_messages, F.when(rem(17, 0), '""').when(rem(19, 0), "null").otherwise(_quoted(day))),
        ),
        _pair("flow", F.when(is_messages, F.when(x % 2 == 0, '"inbound"').otherwise('"outbound"'))),
        _pair("is_deleted", F.when(is_messages, "false")),
        _pair("is_group", F.when(is_chats, (x % 3 == 0).cast("string"))),
        _pair("unread_count", F.when(is_chats, (x % 50).cast("string"))),
        _pair("last_message", F.when(is_chats, nested)),
        _pair("status", F.when(is_agents, F.when(x % 2 == 0, '"online"').otherwise('"offline"'))),
        _pair("created_at", F.when(is_agents, _quoted(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX")))),
        _pair("phone_number", F.when(is_contacts, _quoted(F.col("user_id").cast("string")))),
        _pair("text", F.when(rem(7, 0), _quoted(F.concat(F.lit("text "), eid)))),
        _pair("last_metadata", F.when(rem(11, 0), "null")),
        _pair("extra", F.when(rem(13, 0), nested)),
    )
    action = F.when(x % 20 == 0, "delete").when((x % 20).between(1, 4), "update").otherwise("insert")
    body = _object(
        _pair("record", F.when(rem(113, 1), "null").otherwise(record)),
        _pair("action", _quoted(action)),
        _pair(
            "metadata",
            _object(
                _pair("table_schema", F.lit(f'"{SCHEMA}"')),
                _pair("table_name", _quoted(F.col("mt"))),
                _pair("commit_timestamp", _quoted(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX"))),
                _pair("commit_lsn", (x + 1000000).cast("string")),
            ),
        ),
    )
    subject = F.concat_ws(
        ".",
        F.when(rem(199, 11), "other.changes").otherwise("sequin.changes"),
        F.lit(DATABASE),
        F.lit(SCHEMA),
        F.when(rem(197, 13), "").otherwise(F.col("st")),
        F.when(~rem(101, 7), action),
    )
    # Built once: each of the broken forms below would get a copy of its expression.
    built = settled(tabled.withColumn("body", body), "body")
    body = F.col("body")
    return built.select(
        "event_id",
        "user_id",
        "value",
        "ts",
        subject.alias("subject"),
        F.when(rem(103, 5), F.substring(body, 1, 20))
        .when(rem(307, 20), F.concat(body, F.lit(',"x":1')))
        .when(rem(311, 21), F.concat(F.lit('null,"doc":'), body))
        .when(rem(313, 22), F.concat(body, F.lit(',"__end__":1')))
        .when(rem(317, 23), F.concat(body, F.lit(',"__end__":1}')))
        .when(rem(331, 24), F.concat(body, F.lit(',"__end__":1} and more')))
        .otherwise(body)
        .alias("data"),
    )


def cdc_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivery log: one row per delivery of every change."""
    x = F.col("event_id")

    def delivery(number: int, offset_s: int, cond: Column) -> Column:
        return F.when(cond, F.struct(F.lit(number).alias("number"), F.lit(offset_s).alias("offset_s")))

    deliveries = F.array_compact(
        F.array(
            delivery(0, 0, F.lit(True)),
            delivery(0, 0, x % 35 == 1),  # the same delivery, captured twice
            delivery(1, 60, x % 10 == 0),
            delivery(2, 400, x % 15 == 0),
            delivery(3, 500, x % 45 == 0),
            delivery(4, 300, x % 50 == 0),
        )
    )
    rows = change_events(spark, sf_dir).withColumn("d", F.explode(deliveries))
    received = F.when(x % 401 != 33, F.col("ts") + F.make_dt_interval(secs=F.col("d.offset_s")))
    duration = F.col("value") / F.lit(100)
    timed = rows.select(
        "subject",
        "data",
        (x * 10 + F.col("d.number")).alias("stream_seq"),
        received.alias("received_at"),
        F.concat(F.lit("c"), (F.col("user_id") % 4).cast("string")).alias("consumer_id"),
        duration.alias("duration_s"),
        (~((F.col("d.number") == 0) & (x % 47 == 14))).alias("sink_ok"),
        (~((F.col("d.number") == 0) & (x % 43 == 15))).alias("dedup_ok"),
    )
    micros = F.unix_micros("received_at") + F.round(F.col("duration_s") * 1_000_000).cast("bigint")
    return timed.withColumn("acked_at", F.timestamp_micros(micros))
