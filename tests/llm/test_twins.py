"""Registered queries: their SQL twins, their columns, and that they are in the driver's contract."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_module
from rowtide.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op2_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op4_quality_trees": ["doc_id", "held_out", "score", "predicted"],
    "op5_minhash": ["doc_id", "n_shingles", "component_id", "kept"],
    "op6_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op7_maxent_lm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op11_conversation_repair": [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    ],
    "op12_lexical_search": ["item_id", "rank", "doc_id", "score"],
    "op13_source_mix": ["doc_id", "source", "size", "source_size", "target", "taken"],
    "op8_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    found = duck.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(got.columns)
    plain = lambda v: tuple(v) if isinstance(v, list) else v
    want = sorted(tuple(plain(r[names.index(c)]) for c in got.columns) for r in found.fetchall())
    assert sorted(tuple(plain(v) for v in r) for r in got.collect()) == want


def test_contract_columns_come_first(spark):
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    for name in ("op1_quality_rules", "op2_toxicity", "op4_quality_trees", "op6_packing", "op11_conversation_repair", "op12_lexical_search", "op13_source_mix"):
        assert QUERIES[name](spark, SF).columns[: len(COLUMNS[name])] == COLUMNS[name]
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql())
