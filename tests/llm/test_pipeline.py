"""Each stage of the pipeline against a plain version of its decision, on its own input."""

from __future__ import annotations

import sys
from pathlib import Path

import brute

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline
from rowtide.llm import decontaminate, quality_rules
from rowtide.llm.common import read

SF = "/root/testdata/sf0.001"


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_one_by_one(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "packing"]
    docs = read(spark, SF, "documents")
    columns = docs.columns
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], SF).write.parquet(str(tmp_path / name))
        seen.append(spark.read.parquet(str(tmp_path / name)))
        assert name == "packing" or seen[-1].columns == columns
    start, good, lines, single, clean, packed = seen

    kept, judged = texts(good), texts(start)
    for doc, text in judged.items():
        c = brute.counts(text)
        failed = c["n_words"] < quality_rules.MIN_WORDS or 100 * c["n_repeat_words"] > quality_rules.MAX_REPEATED * c["n_words"]
        assert not (failed and doc in kept)
    labels = {r["doc_id"]: r["quality"] for r in read(spark, SF, "labels").collect()}
    wrongly = [d for d in judged if labels.get(d) == 1 and d not in kept and brute.counts(judged[d])["n_words"] >= 20]
    assert len(wrongly) <= 0.1 * len(labels)

    rows = list(kept.items())
    gone = brute.clean_lines(rows)
    want = {d: "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone[d]) for d, t in rows}
    want = {d: t for d, t in want.items() if not gone[d] or t.split()}
    assert texts(lines) == want
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect() if gone[r["doc_id"]])

    component = brute.near_components(list(want.items()), 5)
    want = {d: t for d, t in want.items() if component[d] == d}
    assert texts(single) == want

    items = [r["text"] for r in read(spark, SF, "benchmark").collect()]
    args = (decontaminate.SPAN, decontaminate.REPLACED, decontaminate.tolerance)
    hit = {d for d, t in want.items() if any(brute.overlaps(t, i, *args) for i in items if set(i.lower().split()) & set(t.lower().split()))}
    assert hit
    want = {d: t for d, t in want.items() if d not in hit}
    assert texts(clean) == want

    pieces = packed.collect()
    assert {r["doc_id"] for r in pieces} == set(want)
    by = {}
    for r in pieces:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 2048


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        read(spark, SF, table).limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
