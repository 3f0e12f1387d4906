"""Quality rules, quality trees and toxicity."""

from __future__ import annotations

import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from rowtide.llm import quality_rules, quality_trees, toxicity
from rowtide.llm.common import read
from rowtide.llm.text_stats import text_counts

SF = "/root/testdata/sf0.01"
DOC = "doc_id bigint, text string"


def odd_texts() -> list[str | None]:
    dice = random.Random(3)
    words = ["a", "b", "éß", "C#", "x|y", "ü", "🙂", "zz.", "10%"]
    made = [
        dice.choice(["", " ", "\t"]) + dice.choice([" ", "  ", "\n", "\x0b", "  "]).join(dice.choices(words, k=k))
        for k in (1, 2, 7, 8, 9, 15, 16, 17, 40, 200)
        for _ in range(6)
    ]
    line = "one two three four five six seven eight nine"
    return [None, "", "   ", "\n\n", f"{line}\n{line}", f"{line} {line} tail", "z " * 30, *made, "long " * 30_000]


def test_counts_match_brute_force(spark):
    texts = odd_texts()
    got = text_counts(spark.createDataFrame(list(enumerate(texts)), DOC)).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute.counts(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want


def rows_for_rules(spark, n=400):
    dice = random.Random(1)
    clean = [" ".join(f"w{dice.randrange(500)}" for _ in range(60)) + "." for _ in range(n)]
    junk = [" ".join(f"w{dice.randrange(500)}$$$" for _ in range(60)) for _ in range(n // 3)]
    rows = [(i, t, int(i < n)) for i, t in enumerate(clean + junk)]
    frame = spark.createDataFrame(rows, DOC + ", quality int")
    return frame.select("doc_id", "text"), frame.select("doc_id", "quality")


def test_rules_are_learned_and_ordered(spark):
    docs, labels = rows_for_rules(spark)
    judged = quality_rules.quality_verdicts(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in judged if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert held and all(r["kept"] == bool(r["quality"]) for r in held)
    assert {r["rule"] is None for r in held if not r["quality"]} == {False}


def test_rules_without_labels_keep_what_the_base_keeps(spark):
    docs, labels = rows_for_rules(spark, 40)
    for none in (labels.limit(0), labels.withColumn("quality", F.lit(None).cast("int")), labels.filter("quality = 1")):
        judged = quality_rules.quality_verdicts(docs, none)
        assert judged.filter("kept = base_failed").count() == 0
    assert quality_rules.quality_verdicts(docs.limit(0), labels).count() == 0


def test_rules_base_edges(spark):
    line = " ".join(f"u{k}" for k in range(8))
    rest = " ".join(f"v{k}" for k in range(40))
    texts = [" ".join(["w"] * 0 + [f"w{k}" for k in range(n)]) for n in (19, 20)] + [f"{line} {rest} {line}"]
    rows = quality_rules.quality_verdicts(
        spark.createDataFrame(list(enumerate(texts)), DOC), spark.createDataFrame([], "doc_id bigint, quality int")
    )
    got = {r["doc_id"]: (r["n_repeat_words"], r["base_failed"]) for r in rows.collect()}
    assert got == {0: (0, True), 1: (0, False), 2: (16, False)}


def test_keep_good_passes_columns_through(spark):
    docs, labels = rows_for_rules(spark, 200)
    docs = docs.selectExpr("doc_id", "text", "'x' AS n_words", "doc_id AS label", "text AS rule", "1 AS kept")
    docs = docs.unionByName(docs.limit(1)).unionByName(
        spark.createDataFrame([(None, None)], DOC).selectExpr("*", "null AS n_words", "0L AS label", "null AS rule", "1 AS kept")
    )
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert set(ids) <= set(range(200)) and len(set(ids)) >= 190


def test_trees_learn_an_interaction():
    dice = np.random.default_rng(0)
    x = dice.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality_trees.fit_trees(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97
    # The walk through the arrays is that of a plain descent.
    row, total = x[3000], model.prior
    for f, t, v in zip(model.feature, model.threshold, model.value, strict=True):
        node = 0
        while node < len(f):
            node = 2 * node + 1 + (row[f[node]] > t[node])
        total += v[node - len(f)]
    assert model.score(x[3000:3001])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_trees_without_anything_to_learn():
    none = quality_trees.fit_trees(np.zeros((0, 3)), np.zeros(0))
    assert none.score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    one = quality_trees.fit_trees(np.ones((10, 3)), np.ones(10))
    assert (one.score(np.zeros((2, 3))) > 0.5).all()


def auc(score, label):
    pos, neg = score[label == 1], score[label == 0]
    return np.mean([(pos > x).mean() + (pos == x).mean() / 2 for x in neg])


@pytest.mark.parametrize("label", ["quality", "toxic"])
def test_held_out_accuracy(spark, label):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    scores = (quality_trees.quality_scores if label == "quality" else toxicity.toxicity_scores)(docs, labels)
    got = scores.join(labels, "doc_id").filter("held_out").toPandas()
    assert auc(got["score"].to_numpy(), got[label].to_numpy()) > (0.95 if label == "quality" else 0.8)
    assert got["score"].between(0, 1).all()


@pytest.mark.parametrize("score", [quality_trees.quality_scores, toxicity.toxicity_scores])
def test_scores_of_odd_rows(spark, score):
    rows = [(1, None), (1, None), (2, ""), (3, "you are an idiot " * 3), (None, "a"), (4, "b " * 50_000)]
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "'y' AS score", "0 AS label", "0 AS held_out")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = score(docs, labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 1}) == 1
    assert score(docs.limit(0), labels).count() == 0
    assert score(docs, labels.limit(0)).count() == len(rows)


def plain_grammar():
    terminals = {w: toxicity._SYMBOL[k] for k, ws in toxicity.SEEDS.items() for w in ws.split()}
    return toxicity.Grammar(terminals, {"lowei": toxicity.INSULT}, toxicity.prior_weights()[0])


def score_of(text: str, g=None) -> float:
    g = g or plain_grammar()
    x = np.frombuffer(toxicity.matcher(g)(text.encode())[0], np.uint8)
    return float(x @ g.weights[:-1] + g.weights[-1])


def test_clauses_weigh_more_than_words():
    plain = score_of("the idiot left")
    assert score_of("you are an idiot") > plain > score_of("nobody here")
    assert score_of("you are not an idiot") < score_of("you are an idiot")
    assert score_of("he said idiot") < score_of("he is idiot")
    assert score_of("i will kill you") > score_of("will that do")
    assert score_of("idiot. moron. scum.") > score_of("idiot.")
    assert score_of("a loweitum word") == score_of("the idiot left")
    # A negation ends with its clause.
    assert score_of("it is not so. you idiot") == score_of("so be it. you idiot")


def test_the_learned_model_reads_clauses(spark):
    g = toxicity.learn_grammar(read(spark, SF, "documents"), read(spark, SF, "labels"))
    said = score_of("You are an idiot.", g)
    for harmless in ("He is not an idiot. ", "She said idiot. ", "Du bist kein idiot. ", "Elle a dit imbécil. "):
        assert said > score_of(harmless * 4, g) == score_of("nobody here", g)
    assert score_of("You are an idiot. " * 4, g) > said


def test_a_very_long_text_has_no_limit():
    features = toxicity.matcher(plain_grammar())
    (few, n), (many, m) = features(b"you idiot. " * 300), features(b"you idiot. " * 30_000)
    assert (n, m) == (300, 30_000) and max(many) > max(few)


def test_composed_table_equals_its_parts():
    step, patterns = toxicity.compose()
    states = [(a, b, c, d, e) for a in range(3) for b in range(4) for c in range(3) for d in range(3) for e in range(3)]
    for s, state in enumerate(states):
        for symbol in range(toxicity.END):
            want = tuple(p.get((q, symbol), q) for p, q in zip(toxicity.PARTS, state, strict=True))
            assert states[step[s][symbol]] == want
    assert max(patterns) == toxicity.PATTERNS - 1
