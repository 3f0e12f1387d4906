"""Work is spread over the cores, and state over shards, however the input is cut."""

from __future__ import annotations

import datetime as dt
import glob
import uuid

from helpers import T0
from pyspark.sql import functions as F

from rowtide.functions.envelope import decode_envelope
from rowtide.functions.records import type_errors
from rowtide.llm import decontaminate
from rowtide.operators import classify as C
from rowtide.plans import stream_queries
from rowtide.plans.stream_queries import PARTS, _captured
from rowtide.session import materialize, shared_dir
from rowtide.sources.event_log import cdc_log, change_events
from rowtide.streaming.dedup import data_batches_only, dedup_ttl_stream

SF_DIR = "/root/testdata/sf0.001"


def test_classification_is_dealt_before_the_bodies_are_built(spark):
    plan = C.classify(cdc_log(spark, SF_DIR)).filter(F.col("error_code") == "unknown_table")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    dealt = text.index("RepartitionByExpression [event_id")
    assert max(text.rfind("get_json"), text.rfind("from_json"), text.rfind('{"doc":')) < dealt
    assert '"record"' not in text[dealt:]


def test_a_body_is_built_once_for_all_its_broken_forms(spark):
    plan = change_events(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count('"commit_lsn":') == 1


def test_the_body_is_not_read_a_third_time_for_its_keys(spark):
    plan = C.classify(cdc_log(spark, SF_DIR))._jdf.queryExecution().optimizedPlan().toString()
    plan = plan.lower().replace("_", "")
    assert "lengthofjsonarray" in plan and "jsonobjectkeys" not in plan


def test_types_are_checked_by_one_condition_for_all_fields(spark):
    row = '{"id":1.5,"agent_id":7,"is_deleted":"no","message_date":"2024-13-01","nope":{}}'
    rows = spark.sql(f"SELECT from_json('{row}', 'map<string,variant>') AS record, t FROM VALUES ('messages'), ('chats'), ('other') AS x(t)")
    got = rows.select("t", type_errors("record", "t").alias("e"))
    text = got._jdf.queryExecution().analyzed().toString().lower().replace("_", "")
    assert text.count("schemaofvariant") < 10
    found = {r.t: r.e for r in got.collect()}
    assert found["other"] is None and found["messages"][0] == "id" and set(found["chats"]) >= {"id", "agent_id"}
    assert set(found["messages"]) >= {"id", "agent_id", "is_deleted", "message_date"} and "nope" not in found["messages"]


def test_whatever_follows_a_body_makes_it_undecodable(spark):
    whole = '{"record":{"id":1},"action":"insert","metadata":{"table_name":"chats"}}'
    tails = [
        ",", "}", "]", "]}", "}]", '"', " x", ',"x":1', ',"x":{}', '],"x":[', '],"x":[{}', '}],"x":[{', f",{whole}", f" {whole}",
        f"],[{whole}", f'],"doc":[{whole}', ',"__end__":1}', ',"__end__":1} tail', ',"__end__":1}]', '],"__end__":1}', ']} ["',
        ',"__end__":1},{"doc":null', f',"doc":{whole}', f'],"doc":{whole}', ',"doc":null', "//", "/* */", "\x00", ":1", ",null",
    ]
    bodies = [(whole + t, t) for t in tails] + [(whole, None), (f" {whole}\n", None), ("null", None)]
    rows = decode_envelope(spark.createDataFrame(bodies, "data string, tail string")).collect()
    assert {r.tail: r.decodable for r in rows if r.tail} == {t: False for t in tails}
    assert [r.decodable for r in rows if r.tail is None] == [True, True, True]


def test_a_part_of_the_log_is_a_file_per_core(spark):
    path, files = _captured(spark, SF_DIR, f"{shared_dir(spark)}/captured-{uuid.uuid4().hex}")
    assert files == spark.sparkContext.defaultParallelism
    assert len(glob.glob(f"{path}/*.parquet")) == PARTS * files
    got = spark.read.parquet(path)
    by_part = got.withColumn("file", F.input_file_name()).groupBy("part").agg(F.countDistinct("file").alias("n"))
    assert {r.part: r.n for r in by_part.collect()} == {p: files for p in range(PARTS)}
    assert got.drop("part").exceptAll(cdc_log(spark, SF_DIR).select(*got.drop("part").columns)).count() == 0
    assert got.count() == cdc_log(spark, SF_DIR).count()


def test_bodies_of_the_log_are_built_by_compiled_code(spark, monkeypatch):
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(name)

    def spy(df, label):
        seen.append(int(spark.conf.get(name)))
        return materialize(df, label)

    monkeypatch.setattr(stream_queries, "materialize", spy)
    _captured(spark, SF_DIR, f"{shared_dir(spark)}/captured-{uuid.uuid4().hex}")
    assert seen == [8000] and spark.conf.get(name) == before


def test_state_is_held_by_shard(spark):
    work = f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    schema = "event_id string, received_at timestamp, stream_seq bigint, sink_ok boolean"

    def rows(seconds, first, ok=lambda k: True):
        return [
            (f"k{k}" if k else None, T0 + dt.timedelta(seconds=s), first + 1000 * i + k, ok(k))
            for i, s in enumerate(seconds)
            for k in range(200)
        ]

    batches = [rows([0, 100], 0, lambda k: k % 2 == 0), rows([299, 300, 450], 10_000), rows([750], 20_000)]
    for part in batches:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{work}/log")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/log")
    with data_batches_only(spark):
        query = (
            dedup_ttl_stream(stream, published="sink_ok", shards=16)
            .writeStream.format("parquet")
            .option("path", f"{work}/out")
            .option("checkpointLocation", f"{work}/cp")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 16
    got = {r.stream_seq: r.dedup for r in spark.read.parquet(f"{work}/out").collect()}
    even = ["miss", "hit", "hit", "miss", "hit", "miss"]  # windows from 0, 300 and 750
    odd = ["miss", "miss", "miss", "hit", "hit", "miss"]  # failed twice, windows from 299 and 750
    places = [0, 1000, 10_000, 11_000, 12_000, 20_000]
    assert got == {p + k: (odd if k % 2 else even)[i] for k in range(200) for i, p in enumerate(places)}


def test_words_of_a_text_are_read_once_for_its_seeds(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seeds = decontaminate._seeds(docs.select("doc_id", decontaminate._hashes("text").alias("_h")), "doc_id")
    plan = seeds._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
