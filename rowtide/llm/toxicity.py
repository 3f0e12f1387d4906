"""Toxicity by a weighted grammar of finite-state patterns.

Words are read as terminal symbols: insult, threat, modal, second or third
person target, negation, reported speech, end of clause. Five small transducers
(one per aspect) run over the symbols of a clause; their product is composed
into one table. The state at the end of a clause is a pattern, for example "an
insult with a target, negated". A pattern that is negated or reported asserts
nothing and counts as no match; a document is the multiset of the others, and
its score a logistic sum of their weights. No word counts outside its clause.

Terminals and weights are learned from labelled rows: words, and stems that
several words share, which mark toxic documents in many different contexts
become insults. The contexts keep the ordinary words of one much-copied toxic
text out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowtide.llm.common import fold_of, labelled, materialize
from rowtide.session import ship

FIT_ROWS = 20_000
STEMS = (4, 5, 6)
MIN_CONTEXTS = 6
MIN_DOCS = 6
MIN_PRECISION = 0.85
CHANCE = 1e-6  # that a term of no meaning stands in toxic documents only
CUTOFF = 0.5
CACHE = 400_000

# The seed terminals.
SEEDS = {
    "insult": "idiot moron stupid dumb loser scum trash worthless pathetic disgusting clown fool imbecile cretin "
    "bastard jerk vermin filth dumm trottel versager abschaum bête débile ordure raclure estúpido imbécil basura",
    "threat": "kill hurt destroy murder stab shoot strangle beat crush burn "
    "töten umbringen verprügeln erschlagen tuer frapper brûler étrangler matar golpear quemar",
    "modal": "will gonna shall should must going werde werden wirst wird sollst vais vas va allons devrait voy vamos debes",
    "you": "you your yours yourself u ur dich dir dein deine ihr euch tu toi vous ton votre tú eres usted ustedes",
    "them": "he she they him her them his their er ihm ihn il ils elle elles lui él ellos ellas",
    "not": "not never no nor hardly isn't aren't don't won't can't cannot ain't "
    "nicht nie niemals kein keine keiner pas jamais aucun aucune nunca jamás ningún",
    "report": "said says wrote writes called calls quoted reported claimed told "
    "sagt sagte schrieb nannte behauptete dit écrit écrivait appelait dijo escribió llamó",
}

# Symbols. A clause end follows a word as a mark on it.
NONE, INSULT, THREAT, MODAL, YOU, THEM, NOT, REPORT, END = range(9)
_SYMBOL = {"insult": INSULT, "threat": THREAT, "modal": MODAL, "you": YOU, "them": THEM, "not": NOT, "report": REPORT}
ENDS = 16  # added to the symbol of a word that closes its clause

# One transducer per aspect: (state, symbol) -> state; other symbols leave the state.
INSULTS = {(0, INSULT): 1, (1, INSULT): 2}
THREATS = {(0, MODAL): 1, (0, THREAT): 2, (1, THREAT): 3}
TARGETS = {(0, YOU): 1, (0, THEM): 2, (2, YOU): 1}
NEGATIONS = {(0, NOT): 1, (1, INSULT): 2, (1, THREAT): 2}
REPORTS = {(0, REPORT): 1, (1, INSULT): 2, (1, THREAT): 2}
PARTS = (INSULTS, THREATS, TARGETS, NEGATIONS, REPORTS)
SIZES = (3, 4, 3, 3, 3)


def compose(parts=PARTS, sizes=SIZES) -> tuple[list[list[int]], list[int]]:
    """The product automaton: next state by state and symbol, and the pattern of each state (-1: none)."""
    states = list(product(*map(range, sizes)))
    number = {s: i for i, s in enumerate(states)}
    step = [[number[tuple(p.get((q, a), q) for p, q in zip(parts, s, strict=True))] for a in range(END)] for s in states]
    patterns = []
    for insult, threat, target, negated, reported in states:
        kind = insult if threat < 2 else 3 + (insult > 0)  # 1 insult, 2 several, 3 threat, 4 both
        where = (target * 2 + (negated == 2)) * 2 + (reported == 2)
        patterns.append(-1 if kind == 0 else (kind - 1) * 12 + where)
    return step, patterns


PATTERNS = 4 * 12
ASSERTED = [i for i in range(PATTERNS) if i % 4 == 0]  # neither negated nor reported
KINDS = len(ASSERTED)
FEATURES = KINDS + 4  # and whether at least 1, 2, 3, 4 clauses assert something


def prior_weights() -> tuple[np.ndarray, np.ndarray]:
    """Weights before any label is seen, and how firmly they are held; the bias is last."""
    w = np.zeros(FEATURES + 1)
    for f, pattern in enumerate(ASSERTED):
        kind, where = divmod(pattern, 12)
        w[f] = (0.4, 0.8, 0.8, 1.2)[kind] + 0.4 * (where > 0)
    w[KINDS:FEATURES] = (0.3, 0.6, 0.6, 0.3)
    w[-1] = -2.0
    hold = np.full(FEATURES + 1, 1.0)
    hold[-1] = 0.05
    return w, hold


_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_CLOSES = re.compile(r"[.!?;:|]+[\"'»”)]*$")


def bare(word: str) -> str:
    """The word in lower case without punctuation around it."""
    return _EDGE.sub("", word).lower()


@dataclass(frozen=True)
class Grammar:
    terminals: dict[str, int]
    stems: dict[str, int]
    weights: np.ndarray

    def symbol(self, word: str) -> int:
        core = bare(word)
        out = self.terminals.get(core, NONE)
        if out == NONE:
            out = next((self.stems[core[:n]] for n in STEMS if len(core) > n and core[:n] in self.stems), NONE)
        return out + ENDS * bool(_CLOSES.search(word))


class _Symbols(dict):
    """Symbol by word as written, remembered up to a bound."""

    def __init__(self, grammar: Grammar) -> None:
        super().__init__()
        self.grammar = grammar

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        out = self[word] = self.grammar.symbol(word.decode("utf-8", "replace"))
        return out


def matcher(grammar: Grammar):
    """A function from the bytes of a text to its features (uint8) and the number of its asserting clauses.

    Clauses of a pattern count by the bit length of their number, so that a
    very long text needs no limit and each doubling weighs the same.
    """
    step, patterns = compose()
    feature = {pattern: f for f, pattern in enumerate(ASSERTED)}
    symbols = _Symbols(grammar)
    hot = bytes([INSULT, THREAT, INSULT + ENDS, THREAT + ENDS])
    nothing = bytes(FEATURES), 0

    def features(text: bytes) -> tuple[bytes, int]:
        lines = text.split(b"\n") if b"\n" in text else [text]
        read = bytes([ENDS]).join(bytes(map(symbols.__getitem__, line.split())) for line in lines)
        read = read.translate(None, b"\0")
        if not any(h in read for h in hot):
            return nothing
        out = [0] * KINDS
        for clause in _clauses(read):
            state = 0
            for a in clause:
                state = step[state][a]
            if patterns[state] in feature:
                out[feature[patterns[state]]] += 1
        clauses = sum(out)
        return bytes([*(x.bit_length() for x in out), *(int(clauses > k) for k in range(4))]), clauses

    return features


def _clauses(read: bytes) -> Iterator[list[int]]:
    clause: list[int] = []
    for a in read:
        if a % ENDS:
            clause.append(a % ENDS)
        if a >= ENDS:
            yield clause
            clause = []
    yield clause


def _texts(docs: DataFrame, *others) -> DataFrame:
    return docs.select(*others, F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def learn_terminals(sample: DataFrame) -> tuple[dict[str, int], dict[str, int]]:
    """Terminals and stems from the seeds and from ``sample`` (label, text).

    A word or stem becomes an insult when more toxic documents have it than
    chance explains, nearly no others do, and it stands after many different words.
    Counts are partial per task and then added by term.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: dict[tuple[str, int], list[int]] = {}
            for label, text in zip(b.column("label").to_pylist(), b.column("text").to_pylist(), strict=True):
                words = [bare(w.decode("utf-8", "replace")) for w in text.split()]
                seen = set()
                for before, w in zip(["", *words], words, strict=False):
                    for n in (0, *(n for n in STEMS if n < len(w))):
                        term = (w[:n], n) if n else (w, 0)
                        row = rows.setdefault(term, [0, 0, 0, 0])
                        if label:
                            row[2] |= 1 << (zlib.crc32(before.encode()) % 63)
                            row[3] |= 1 << (zlib.crc32(w.encode()) % 63)
                        if term not in seen:
                            seen.add(term)
                            row[0 if label else 1] += 1
            if rows:
                terms, stems = zip(*rows, strict=True)
                cells = [pa.array(c, pa.int64()) for c in zip(*rows.values(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms), pa.array(stems, pa.int32()), *cells],
                    ["term", "stem", "toxic", "clean", "contexts", "forms"],
                )

    totals = sample.groupBy("label").count().collect()
    toxic, clean = (sum(r["count"] for r in totals if bool(r["label"]) == want) for want in (True, False))
    terms: dict[str, int] = {w: _SYMBOL[k] for k, ws in SEEDS.items() for w in ws.split()}
    stems: dict[str, int] = {}
    if not toxic or not clean:
        return terms, stems
    counted = (
        sample.mapInArrow(count, "term string, stem int, toxic long, clean long, contexts long, forms long")
        .groupBy("term", "stem")
        .agg(
            F.sum("toxic").alias("toxic"),
            F.sum("clean").alias("clean"),
            F.bit_count(F.bit_or("contexts")).alias("contexts"),
            F.bit_count(F.bit_or("forms")).alias("forms"),
        )
    )
    # Precision as it would be if both classes were equally frequent.
    share = F.col("toxic") / toxic
    precise = share / (share + (F.col("clean") + 0.5) / clean) >= MIN_PRECISION + 0.1
    certain = F.col("toxic") * np.log((toxic + clean) / toxic) >= -np.log(CHANCE)
    found = counted.filter(
        (F.col("toxic") >= MIN_DOCS)
        & certain
        & (F.col("contexts") >= MIN_CONTEXTS)
        & precise
        & (F.col("toxic") >= MIN_PRECISION * (F.col("toxic") + F.col("clean")))
        & ((F.col("stem") == 0) | (F.col("forms") >= 3))
    ).collect()
    for r in found:
        (stems if r["stem"] else terms)[r["term"]] = INSULT
    # A seed that clean documents use freely is not held against them.
    for r in counted.filter((F.col("stem") == 0) & F.col("term").isin(SEEDS["insult"].split())).collect():
        if r["clean"] > r["toxic"] >= 0 and r["toxic"] + r["clean"] >= MIN_DOCS:
            terms.pop(r["term"], None)
    return terms, stems


def fit_weights(x: np.ndarray, toxic: np.ndarray, total: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Logistic weights by Newton steps, drawn towards the prior ones."""
    prior, hold = prior_weights()
    w = prior.copy()
    if not len(x) or toxic.sum() in (0, total.sum()):
        return w
    x = np.hstack([x, np.ones((len(x), 1))])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (toxic - total * p) - hold * (w - prior)
        curve = (x * (total * p * (1 - p))[:, None]).T @ x + np.diag(hold)
        move = np.linalg.solve(curve, gradient)
        w += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return w


def learn_grammar(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Grammar:
    """Learn from at most about ``fit_rows`` labelled rows outside fold 0."""
    ship(docs.sparkSession)
    fit = labelled(labels, "toxic", fit_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(fit), "doc_id").repartition(64, "doc_id")
    sample = materialize(_texts(sample, "label"), "toxicity-fit")
    start = Grammar(*learn_terminals(sample), prior_weights()[0])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = matcher(start)
        for b in batches:
            found = [features(t)[0] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), b.column("label")], ["x", "label"])

    kinds = sample.mapInArrow(read, "x binary, label int").groupBy("x").agg(
        F.sum((F.col("label") > 0).cast("long")).alias("toxic"), F.count("*").alias("total")
    )
    rows = sorted(kinds.collect(), key=lambda r: bytes(r["x"]))
    x = np.array([list(r["x"]) for r in rows], float).reshape(len(rows), FEATURES)
    toxic, total = (np.array([r[c] for r in rows], float) for c in ("toxic", "total"))
    return Grammar(start.terminals, start.stems, fit_weights(x, toxic, total))


def toxicity_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted, clauses`` per row of ``docs``.

    ``clauses`` counts the matched clauses that are neither negated nor
    reported. Null and empty texts match nothing and get the score of such
    texts; very long ones are read whole. Columns of the added names are not
    passed on. Repeated rows get equal scores; rows
    without id are scored and count as not held out.
    """
    ship(docs.sparkSession)
    grammar = learn_grammar(docs, labels, fit_rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = matcher(grammar)
        for b in batches:
            found = [features(t) for t in b.column("text").to_pylist()]
            x = np.frombuffer(b"".join(f for f, _ in found), np.uint8).reshape(-1, FEATURES).astype(float)
            s = 1 / (1 + np.exp(-(x @ grammar.weights[:-1] + grammar.weights[-1])))
            clauses = pa.array([n for _, n in found], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), clauses], ["doc_id", "score", "clauses"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = _texts(docs, "doc_id").mapInArrow(score, f"doc_id {kind}, score double, clauses int")
    return scored.select(
        "doc_id",
        F.coalesce(fold_of(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"),
        "clauses",
    )
