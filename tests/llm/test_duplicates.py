"""MinHash near-duplicates, repeated bytes, line deduplication and decontamination."""

from __future__ import annotations

import hashlib
import random
from itertools import combinations

import brute
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rowtide.llm import decontaminate, line_dedup, minhash, suffix_dedup
from rowtide.llm.common import read
from rowtide.llm.components import components
from rowtide.llm.shingles import WordHashes, shingle_sets

DOC = "doc_id bigint, text string"
SF = "/root/testdata/sf0.001"


def noisy(words: list[str], edits: int, dice: random.Random) -> list[str]:
    out = list(words)
    for _ in range(edits):
        at = dice.randrange(len(out))
        kind = dice.randrange(3)
        if kind == 0:
            out[at] = f"n{dice.randrange(10**6)}"
        elif kind == 1:
            out.insert(at, f"n{dice.randrange(10**6)}")
        elif len(out) > 1:
            del out[at]
    return out


def corpus(seed: int, groups: int = 12, copies: int = 12) -> list[tuple[int, str | None]]:
    dice = random.Random(seed)
    texts: list[str | None] = [None, "", "  \n", "one", "One", "one two", "ONE two"]
    for _ in range(groups):
        words = [f"w{dice.randrange(3000)}" for _ in range(dice.choice([5, 9, 40, 120]))]
        for _ in range(copies):
            texts.append(" ".join(noisy(words, dice.choice([0, 0, 1, 2, 4, 8]), dice)))
    dice.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("size", "seed"), [(2, 1), (5, 2)])
def test_near_duplicates_match_brute_force(spark, size, seed):
    rows = corpus(seed)
    got = minhash.near_duplicates(spark.createDataFrame(rows, DOC), shingle=size).collect()
    want = brute.near_components(rows, size)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["n_shingles"] == len(brute.shingles(rows[r["doc_id"]][1], size)) for r in got)
    assert all(r["kept"] == (want[r["doc_id"]] == r["doc_id"]) for r in got)


def test_a_large_noisy_group_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    dice = random.Random(9)
    words = [f"w{k}" for k in range(80)]
    rows = [(i, " ".join(noisy(words, dice.choice([2, 3, 4, 5]), dice))) for i in range(150)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, DOC), shingle=2).collect()
    want = brute.near_components(rows, 2)
    assert len(set(want.values())) > 1
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_near_duplicates_of_odd_rows(spark):
    text = " ".join(f"a{k}" for k in range(30))
    rows = [(3, text), (3, text), (3, "something else here"), (9, "Something else here"), (None, text), (5, text), (6, None)]
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS component_id", "2 AS rep", "3 AS bands", "'k' AS kept")
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs, 2).collect()]
    assert sorted(got, key=str) == sorted(
        [(3, 3, True), (3, 3, True), (3, 3, True), (9, 3, False), (None, None, True), (5, 3, False), (6, 6, True)], key=str
    )
    kept = minhash.keep_one(docs, 2)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([3, 6, None], key=str)
    assert minhash.near_duplicates(docs.limit(0), 2).count() == 0


def test_shingles_match_brute_force():
    texts = [t for _, t in corpus(4, 6, 4)]
    for size in (1, 2, 5):
        row, hashes = shingle_sets([None if t is None else t.encode() for t in texts], size, WordHashes())
        names: dict[int, tuple[str, ...]] = {}
        for i, t in enumerate(texts):
            mine = hashes[row == i]
            assert len(mine) == len(brute.shingles(t, size))
        all_shingles = {s for t in texts for s in brute.shingles(t, size)}
        assert len(np.unique(hashes)) == len(all_shingles)
        del names


def test_signatures_are_full_and_estimate_similarity():
    known, dice = WordHashes(), random.Random(2)
    for n in (3, 30, 300):
        base = [f"q{dice.randrange(10**6)}" for _ in range(n)]
        other = noisy(base, max(1, n // 20), dice)
        texts = [" ".join(x).encode() for x in (base, other)]
        row, hashes = shingle_sets(texts, 1, known)
        s = minhash.signatures(row, hashes, 2, 128)
        a, b = ({*hashes[row == i].tolist()} for i in (0, 1))
        assert {*s[0].tolist()} <= a and {*s[1].tolist()} <= b
        assert abs((s[0] == s[1]).mean() - len(a & b) / len(a | b)) < 0.25


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(8, 60)]
    got = components(spark.createDataFrame(chain + star + [(500, 499)], "a bigint, b bigint"))
    by = {r["node"]: r["component"] for r in got.collect()}
    assert all(by[i] == 100 for i in range(100, 161)) and all(by[i] == 7 for i in range(7, 60)) and by[500] == 499
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def byte_corpus(seed: int) -> list[tuple[int, str | None]]:
    dice = random.Random(seed)
    passage = "".join(dice.choices("abcdé", k=130))
    texts: list[str | None] = [None, "", "x" * 49, "x" * 50, "x" * 51, "y" * 400, "y" * 90 + "z"]
    for _ in range(40):
        parts = ["".join(dice.choices("abcdefgh \n", k=dice.randrange(0, 90))) for _ in range(3)]
        a = dice.randrange(0, 60)
        parts.insert(dice.randrange(4), passage[a : a + dice.randrange(40, 75)])
        if dice.random() < 0.4:
            parts.append(dice.choice([t for t in texts if t]) or "")
        texts.append("".join(parts))
    texts += texts[10:14]
    dice.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "segment"), [(1, None), (2, 64)])
def test_repeated_bytes_match_brute_force(spark, monkeypatch, seed, segment):
    if segment:
        monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
        monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 300)
    rows = byte_corpus(seed)
    got = suffix_dedup.repeated_bytes(spark.createDataFrame(rows, DOC), texts=True).collect()
    want = brute.cut_bytes(rows)
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want
    for r in got:
        if r["kept"] is not None:
            assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]


def test_repeated_bytes_of_odd_rows(spark):
    text = "0123456789" * 7 + "end"
    rows = [(4, text), (4, text), (4, "head" + text), (2, None), (None, text), (8, text + "!"), (9, text)]
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "'s' AS sha", "1 AS version", "2 AS n_bytes", "3 AS first")
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix_dedup.repeated_bytes(docs).collect())
    n = len(text)
    assert got == sorted(
        [("4", n, 0, 0), ("4", n, 0, 0), ("4", n + 4, 0, 0), ("2", 0, 0, 0), ("None", n, 0, 0), ("8", n + 1, n, 1), ("9", n, n, 1)]
    )
    assert suffix_dedup.repeated_bytes(docs.limit(0)).count() == 0


@pytest.mark.parametrize("rows_a_batch", [1, 3, 100])
def test_covered_stream_splits_no_bucket(monkeypatch, rows_a_batch):
    """Runs sorted by gram, bytes and document, in batches that cut buckets anywhere, against all windows of a bucket."""
    monkeypatch.setattr(suffix_dedup, "REFINE_BYTES", 200)
    dice = random.Random(5)
    rows = []
    for i in range(60):
        a = dice.randrange(0, 12)
        content = "".join(f"{i % 4}{n:03}" for n in range(30))[a : a + dice.randrange(50, 70)].encode()
        rows.append((i % 4, dice.randrange(6), 0, 1000 * i, len(content) - 49, content))
    rows.sort(key=lambda r: (r[0], r[5], r[1]))
    made = [suffix_dedup._rows(suffix_dedup._SENT, list(zip(*rows[i : i + rows_a_batch], strict=True))) for i in range(0, 60, rows_a_batch)]
    got = {b for out in suffix_dedup._covered(iter(made)) for r in out.to_pylist() for b in range(r["begin"], r["end"])}
    first: dict[tuple[int, bytes], int] = {}
    windows = [(g, doc, start + o, c[o : o + 50]) for g, doc, _, start, n, c in rows for o in range(n)]
    for g, doc, _, w in windows:
        first[g, w] = min(doc, first.get((g, w), doc))
    assert got == {b for g, doc, at, w in windows if first[g, w] < doc for b in range(at, at + 50)}


@given(st.lists(st.text("ab", min_size=50, max_size=140), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_refinement_matches_brute_force(texts):
    data = "".join(texts).encode()
    starts = np.cumsum([0, *map(len, texts)])
    windows = np.concatenate([np.arange(s, s + len(t) - 49) for s, t in zip(starts, texts, strict=False)])
    owner = np.concatenate([np.full(len(t) - 49, i) for i, t in enumerate(texts)])
    got = suffix_dedup.refine(np.frombuffer(data, np.uint8), windows, owner, np.zeros(len(windows), np.uint64))
    first: dict[bytes, int] = {}
    for w, o in zip(windows, owner, strict=True):
        first.setdefault(data[w : w + 50], o)
    assert got.tolist() == [first[data[w : w + 50]] < o for w, o in zip(windows, owner, strict=True)]


@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 12)), min_size=1, max_size=12))
def test_union_of_ranges(parts):
    pairs = np.array([(a, a + n) for a, n in parts], np.int64)
    covered = {b for a, z in pairs for b in range(a, z)}
    got = suffix_dedup.union_ranges(pairs)
    assert {b for a, z in got for b in range(a, z)} == covered
    assert len(got) == sum(b - 1 not in covered for b in covered)


def line_corpus(seed: int) -> list[tuple[int, str | None]]:
    dice = random.Random(seed)
    lines = [[f"w{dice.randrange(400)}" for _ in range(dice.randrange(3, 14))] for _ in range(25)]
    docs: list[str | None] = [None, "", "\n\n", "a b c d e\na b c d e\na b c d f\na b c d e g\nb c d e"]
    for _ in range(60):
        docs.append(
            "\n".join("  ".join(noisy(dice.choice(lines), dice.choice([0, 0, 1, 1, 2]), dice)) for _ in range(dice.randrange(1, 5)))
        )
    dice.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_match_brute_force(spark, seed):
    rows = line_corpus(seed)
    got = line_dedup.drop_lines(spark.createDataFrame(rows, DOC)).collect()
    want = brute.clean_lines(rows)
    assert sum(map(len, want.values())) > 20
    for r in got:
        before, gone = rows[r["doc_id"]][1], want[r["doc_id"]]
        if before is None:
            assert r["text"] is None and r["n_lines"] == r["n_removed"] == 0
            continue
        lines = before.split("\n")
        assert (r["n_lines"], r["n_removed"]) == (len(lines), len(gone))
        assert r["text"] == "\n".join(x for k, x in enumerate(lines) if k not in gone)


def test_lines_of_odd_rows(spark):
    line = "one two three four five"
    rows = [(2, line), (2, line), (5, f"{line}\nrest"), (None, line), (6, line), (7, line + " six"), (1, "x"), (8, f"y {line}")]
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "9L AS n_chars", "'l' AS line", "1 AS n_lines", "2 AS _id", "3 AS near")
    got = line_dedup.drop_lines(docs).collect()
    want = [("1", "x"), ("2", line), ("2", line), ("5", "rest"), ("6", ""), ("7", ""), ("8", ""), ("None", line)]
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == want
    kept = line_dedup.clean_lines(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in kept.collect()) == [("1", 9), ("2", 9), ("2", 9), ("5", 4), ("None", 9)]
    assert line_dedup.drop_lines(docs.limit(0)).count() == 0


def test_short_lines_go_as_exact_copies_only(spark):
    rows = [(1, "x\n \none two three four"), (2, "x\nx y\n "), (3, "one  two\tthree four"), (4, "one two three"), (5, "x\nx y")]
    docs = spark.createDataFrame(rows, DOC)
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.drop_lines(docs).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("x y\n ", 1), 3: ("", 1), 4: ("one two three", 0), 5: ("", 2)}
    assert sorted(r["doc_id"] for r in line_dedup.clean_lines(docs).collect()) == [1, 2, 4]


def test_a_very_long_line(spark):
    words = [f"w{k}" for k in range(30_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:15_000] + ["new"] + words[15_000:])), (3, " ".join(words[::2]))]
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup.drop_lines(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


@given(st.lists(st.sampled_from("abc"), max_size=7), st.lists(st.sampled_from("abc"), max_size=7))
@settings(max_examples=200, deadline=None)
def test_line_hashes_of_variants(a, b):
    words = [w.encode() for w in a + b]
    hashes = line_dedup.LineHashes(words, WordHashes())
    n, m = len(a), len(b)
    whole = hashes.part(np.array([n]), np.array([n + m]))[0]
    for i in range(n):
        assert (hashes.without(np.array([0]), np.array([n]), np.array([i]))[0] == whole) == (a[:i] + a[i + 1 :] == b)


def test_masks_are_lossless():
    for gaps in combinations(range(decontaminate.SPAN), decontaminate.REPLACED):
        assert any(
            not {at + o for o in m} & {*gaps} for m in decontaminate.MASKS for at in range(decontaminate.SPAN - m[-1])
        )
    assert decontaminate.tolerance(decontaminate.SPAN) == decontaminate.REPLACED


def test_decontamination_matches_brute_force(spark):
    dice = random.Random(11)
    items = [" ".join(f"t{dice.randrange(300)}" for _ in range(n)) for n in (4, 8, 10, 15, 16, 17, 30, 60)]
    items += [items[6], items[7].upper()]
    texts: list[str | None] = [None, "", items[0], "short text"]
    for n in range(5, 17):
        words = items[7].split()
        for part in (words[-n:], words[:n], words[20 : 20 + n]):
            other = ["other"] * 9
            broken = [*part[:3], "other", *part[4:]]
            texts += [" ".join(x) for x in (part, part + other, other + part, broken, [*broken, *other], part[1:4] + other + part[4:])]
    for item in items:
        words = item.split()
        for replaced in (0, 1, 2, 3, 4, 6):
            mine = list(words)
            for at in dice.sample(range(len(mine)), min(replaced, len(mine))):
                mine[at] = f"r{dice.randrange(10**6)}"
            cut = dice.choice([0, 0, 3, len(mine) // 2])
            lead = [f"t{dice.randrange(300)}" for _ in range(dice.randrange(12))]
            texts.append(" ".join([*lead, *mine[cut:], *lead]))
    rows = list(enumerate(texts))
    got = decontaminate.decontaminate(
        spark.createDataFrame(rows, DOC), spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    ).collect()
    first = {brute.WORD.sub(lambda m: m[0].lower(), t): i for i, t in reversed(list(enumerate(items)))}
    for r in got:
        want = {
            first[t.lower()]
            for t in items
            if len(t.split()) >= decontaminate.MIN_WORDS
            and brute.overlaps(texts[r["doc_id"]], t, decontaminate.SPAN, decontaminate.REPLACED, decontaminate.tolerance)
        }
        assert (r["items"], r["n_items"], r["kept"]) == (sorted(want), len(want), not want), r["doc_id"]


def test_passages_at_the_edges_of_texts(spark):
    words = [f"t{k}" for k in range(40)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    texts = [words[-15:], words[20:35], words[:13] + ["z"] * 5, ["z"] * 5 + words[:13], words[-13:] + ["z"] * 5, ["z"] * 5 + words[-12:], words[3:11], words[3:10]]
    texts += [["z"] * 5 + words[:12], [*words[5:9], "z", *words[10:14]]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], DOC)
    kept = {r["doc_id"] for r in decontaminate.decontaminate(docs, bench).filter("kept").collect()}
    assert kept == {5, 7, 8}


def test_decontamination_of_odd_rows(spark):
    item = " ".join(f"t{k}" for k in range(20))
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (None, item), (3, "")], "item_id bigint, text string")
    rows = [(1, f"a {item} b"), (1, f"a {item} b"), (None, item), (2, None), (3, "t1 t2 " * 20_000)]
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS items", "2 AS k1", "3 AS kept", "4 AS seed")
    got = decontaminate.decontaminate(docs, bench).collect()
    assert sorted((str(r["doc_id"]), r["items"]) for r in got) == [("1", [1]), ("1", [1]), ("2", []), ("3", []), ("None", [1])]
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.limit(0)).filter("NOT kept").count() == 0


def test_whole_small_tables_match_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in read(spark, SF, "documents").select("doc_id", "text").collect()]
    near = minhash.near_duplicates(read(spark, SF, "documents"), shingle=2)
    assert {r["doc_id"]: r["component_id"] for r in near.collect()} == brute.near_components(rows, 2)
    lines = line_dedup.drop_lines(read(spark, SF, "documents").withColumn("was", F.col("text")))
    assert sum(r["n_removed"] for r in lines.select("n_removed").collect()) == sum(map(len, brute.clean_lines(rows).values()))
