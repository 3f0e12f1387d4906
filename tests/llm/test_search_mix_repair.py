"""Conversation repair, lexical search and source mixing against plain versions."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import groupby

import brute
import numpy as np
import pytest

from rowtide.llm import conversation_repair as R, lexical_search as S, source_mix as M
from rowtide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TALK = "conv_id bigint, turn bigint, role string, text string, place string, c int"
ROLES = ["user", "assistant", "system", "tool", "", "admin", None]
TEXTS = ["Yes.", "No!", "cut off", "", " \t", None, "End.  ", "a\nb", "What?\n", "ü€."]


def random_talk(seed: int, convs: int = 40, most: int = 14) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for conv in [*range(convs), None]:
        for turn in range(rng.randrange(most)):
            text = rng.choice(TEXTS) if rng.random() < 0.5 else f"text {rng.randrange(5)}{rng.choice('.,')}"
            turn = rng.choice([turn, turn, turn, turn + 2, None])
            rows.append((conv, turn, rng.choice(ROLES[:3] * 3 + ROLES), text))
    return rows


def reports(frame) -> dict:
    return {r.conv_id: r.asDict() for r in frame.collect()}


def talk_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], TALK)


def expected(rows: list[tuple], originals: list) -> dict:
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, " " if role is None else role, " " if text is None else text))
    return {c: brute.repaired(by_conv[c]) for c in originals}


@pytest.mark.parametrize("parts", [1, 5, 60])
def test_repair_equals_plain_version(spark, parts):
    """Also with so many parts that most conversations span several."""
    rows = random_talk(parts)
    frame = talk_frame(spark, rows)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = reports(R.structure_report(R.damage(frame), frame))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
    want = expected(brute.damaged(rows), sorted({r[0] for r in rows}, key=str))
    assert got.keys() == want.keys()
    for conv, report in got.items():
        assert {k: want[conv][k] for k in report if k != "conv_id"} == {k: v for k, v in report.items() if k != "conv_id"}


def test_repair_of_given_conversations(spark):
    talks = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in talks.select("conv_id", "turn", "role", "text").collect()]
    got = reports(QUERIES["op11_conversation_repair"](spark, SF))
    want = expected(brute.damaged(rows), sorted({r[0] for r in rows}))
    assert got == {c: {"conv_id": c} | {k: v for k, v in w.items() if k != "lines"} for c, w in want.items()}
    assert all(re.fullmatch(r"[DIKR]*", r["audit"]) for r in got.values())


def test_repaired_rows_are_legal(spark):
    rows = random_talk(9)
    out = R.repair_conversations(talk_frame(spark, rows)).orderBy("conv_id", "place").collect()
    want = expected(rows, list({r[0] for r in rows}))
    for conv, talk in groupby(out, key=lambda r: r.conv_id):
        talk = list(talk)
        assert [r.place for r in talk] == list(range(1, len(talk) + 1))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in talk))
        assert [f"{r.role}:{r.text}" for r in talk] == want[conv]["lines"]


def test_hot_conversation_and_long_runs(spark):
    """One conversation spans all parts; another repeats one row many times."""
    rows = [(1, t, ROLES[t % 2] if t % 7 else "user", f"line {t}.") for t in range(3000)]
    rows += [(2, 0, "user", "same.")] * 500 + [(2, 1, "assistant", "end" * 100_000)]
    rows += [(3, None, "user", f"{k}!") for k in range(300)]
    frame = talk_frame(spark, rows)
    got = reports(R.structure_report(frame, frame))
    want = expected(rows, [1, 2, 3])
    assert got == {c: {"conv_id": c} | {k: v for k, v in w.items() if k != "lines"} for c, w in want.items()}
    assert got[2]["audit"] == "K" + "D" * 499 + "K" and got[2]["cost"] == 499 * 4 + 3


def test_powers_equal_single_steps():
    rng = random.Random(3)
    for _ in range(200):
        symbol, length = rng.randrange(9), rng.randrange(1, 40)
        costs = tuple(rng.randrange(20) for _ in range(4))
        single = costs
        for _ in range(length):
            single = R.advance([(symbol, 1)], single)
        assert R.advance([(symbol, length)], costs) == single
        assert R._apply(R.product([(symbol, length)]), costs) == single


def test_no_conversations(spark):
    none = talk_frame(spark, [])
    assert R.structure_report(none, none).collect() == [] and R.repair_conversations(none).collect() == []
    lost = talk_frame(spark, [(5, 1, "user", "x.")])
    (row,) = R.structure_report(none, lost).collect()
    assert (row.conv_id, row.cost, row.audit) == (5, 0, "") and row.repaired_sha256.startswith("e3b0c442")


# -- lexical search -----------------------------------------------------------------------------

DOCS = "doc_id bigint, text string, source string, s int, h string, n int, size int"


def docs_frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "h", 1, 2) for r in rows], DOCS)


def random_docs(seed: int, n: int = 200) -> list[tuple]:
    rng = random.Random(seed)
    words = ["the", "The", "ofé", "x1", "Ünter", "a_b", "c-d", "zz", "9", "été", "ß"] + [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60))), f"s{rng.randrange(4)}") for i in range(n)]
    rows += [(i + n, rows[i][1], "s1") for i in range(0, n, 3)]  # ties
    rows += [(rows[3][0], rows[3][1], "s1"), (9000, None, None), (9001, "", "é"), (9002, "...", "Z"), (None, "the w1", None)]
    return rows


ITEMS = [(1, "The W1 w2 w2"), (2, "été ofé Ünter_x1"), (3, None), (4, ""), (5, "nowhere"), (None, "the"), (6, "w5"), (6, "W6 the")]


def test_search_equals_plain_version(spark, monkeypatch):
    rows = random_docs(1)
    items = spark.createDataFrame([(*i, 1) for i in ITEMS], "item_id int, text string, rank int")
    want = brute.search([r[:2] for r in rows], ITEMS)
    # Rows of one id are documents of their own.
    got = S.search_documents(docs_frame(spark, rows), items)
    assert sorted(tuple(r) for r in got.collect()) == want
    monkeypatch.setattr(S, "PAIRS", 7)
    monkeypatch.setattr(S, "PIECE_BYTES", 5)
    blocks = S.search_documents(docs_frame(spark, rows), items, index_bytes=16)
    assert sorted(tuple(r) for r in blocks.collect()) == want


def test_small_runs_and_long_texts_change_nothing():
    rng = np.random.default_rng(0)
    heaps, rows = S.Heaps(3, 4), []
    for _ in range(50):
        item, score, doc = rng.integers(0, 3, 20), rng.integers(1, 9, 20), rng.permutation(1000)[:20]
        heaps.add(item, score, doc)
        rows += list(zip(item.tolist(), (-score).tolist(), doc.tolist()))
    for item in range(3):
        best = sorted((s, d) for i, s, d in rows if i == item)[:4]
        assert [(-int(s), int(d)) for s, d in zip(heaps.score[item], heaps.doc[item])] == best
    text = b"AbC de\xc3\xa9 " * 300_000
    assert [w for part in S.pieces(text) for w in part] == [b"abc", b"de\xc3\xa9"] * 300_000


def test_search_in_nothing(spark):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert S.search_documents(docs_frame(spark, []), items).collect() == []
    assert S.search_documents(docs_frame(spark, random_docs(2)), items.limit(0)).collect() == []
    assert S.search_documents(docs_frame(spark, [(1, None, "a")]), items).collect() == []


# -- source mixing --------------------------------------------------------------------------------


def check_mix(rows: list[tuple], out: list) -> None:
    sizes: dict = defaultdict(int)
    largest: dict = defaultdict(int)
    for _, text, source in rows:
        words = len(brute.WORD.findall(text or ""))
        sizes[source] += words
        largest[source] = max(largest[source], words)
    target = brute.mix_targets(sizes)
    taken: dict = defaultdict(int)
    assert len(out) == len(rows)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    for source, words in taken.items():
        assert abs(words - target[source]) <= 2 * largest[source]


def test_mix_reaches_its_targets(spark):
    rows = random_docs(4, 900)
    out = M.mix_sources(docs_frame(spark, rows)).collect()
    check_mix(rows, out)
    again = M.mix_sources(docs_frame(spark, rows[::-1]).repartition(7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_boundary_is_refined_to_single_documents(spark, monkeypatch):
    monkeypatch.setattr(M, "BITS", 4)
    monkeypatch.setattr(M, "LEVELS", 15)
    monkeypatch.setattr(M, "BROADCAST_BYTES", 0)
    rows = [(i, "word " * (1 + i % 3), ["a", "b", None][i % 3 if i % 2 else 0]) for i in range(1200)]
    check_mix(rows, M.mix_sources(docs_frame(spark, rows)).collect())


def test_larger_budgets_contain_smaller_ones(spark):
    docs = docs_frame(spark, random_docs(5, 500))
    less, more = ({r.doc_id: r.taken for r in M.mix_sources(docs, share=s).collect()} for s in (0.4, 1.1))
    assert all(more[d] >= taken for d, taken in less.items())


def test_mix_of_nothing(spark):
    assert M.mix_sources(docs_frame(spark, [])).collect() == []
    empty = M.mix_sources(docs_frame(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in empty] == [(0, 0.0, 0)] * 2
    long = M.mix_sources(docs_frame(spark, [(1, "w " * 500_000, "a"), (2, "x", "b")])).collect()
    assert sorted((r.doc_id, r.size, r.taken) for r in long) == [(1, 500_000, 500_000), (2, 1, 2)]


def test_mix_stays_in_the_jvm(spark):
    plan = M.mix_sources(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan
    assert "Window" not in plan
