"""Token counts, packing and language-model scores."""

from __future__ import annotations

import collections
import dataclasses
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer, models, normalizers

from rowtide.llm import maxent_lm, packing, token_counts
from rowtide.llm.common import materialize, read

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  a  b ", "\n\n x", "日本語 <s> 🙂🙂", "a  ", "<0x0A>", "<unk>", "▁ ▁▁", "İstanbul ΣΑΣ", "é ́e"]


def unigram(vocabulary, fallback):
    out = Tokenizer(models.Unigram(vocabulary, 0, fallback))
    mark = token_counts.MARK
    out.normalizer = normalizers.Sequence([normalizers.Prepend(mark), normalizers.Replace(" ", mark)])
    return out


def test_counts_equal_the_tokenizer(spark):
    vocabulary = token_counts.read_vocabulary(PIECES)
    exact, model = unigram(vocabulary, True), token_counts.Viterbi(vocabulary)
    assert model.by_word
    texts = [r["text"] for r in read(spark, SF, "documents").collect()] + ODD
    for t in texts:
        assert model.text(t) == len(exact.encode(t, add_special_tokens=False).ids), t[:60]


@given(
    st.dictionaries(st.text("ab▁", min_size=1, max_size=4), st.integers(-3, 0), min_size=1, max_size=12),
    st.text("abc  ", max_size=14),
)
@settings(max_examples=300, deadline=None)
def test_ties_follow_the_tokenizer(pieces, text):
    vocabulary = [("<unk>", 0.0), *((p, float(s)) for p, s in pieces.items())]
    want = len(unigram(vocabulary, False).encode(text, add_special_tokens=False).ids)
    assert token_counts.Viterbi(vocabulary).text(text) == want


def test_count_tokens_of_odd_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (None, "a b"), (3, "word " * 50_000)]
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "'x' AS n_tokens", "1 AS _text", "2 AS _row")
    got = token_counts.count_tokens(docs, PIECES)
    assert got.columns == ["doc_id", "_text", "_row", "n_tokens"]
    by = {r["doc_id"]: r["n_tokens"] for r in got.collect()}
    assert by[1] == by[2] == 0 and by[None] > 0 and by[3] > 50_000
    assert token_counts.count_tokens(docs.limit(0), PIECES).count() == 0


def word_ids(text: str) -> list[int]:
    return np.frombuffer(packing._KNOWN.setdefault(WORDS, packing.WordIds(WORDS)).texts([text.encode()])[0], "<u4").tolist()


EXACT = Tokenizer.from_file(WORDS)


@given(st.one_of(st.text(max_size=60), st.text("aBé'sÉ́ \t\n<|endoftx>|ΣİK", max_size=60)))
@settings(max_examples=400, deadline=None)
def test_ids_by_word_equal_ids_of_the_text(text):
    assert word_ids(text) == EXACT.encode(text, add_special_tokens=False).ids


def test_ids_of_special_marks():
    for text in ("a<|endoftext|>b", "A<|EndOfText|> b <|startoftext|>", "It's WE'RE"):
        assert word_ids(text) == EXACT.encode(text, add_special_tokens=False).ids


def check_packing(rows, capacity):
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_holds_every_piece(spark):
    docs = read(spark, SF, "documents").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(None, None), (7, ""), (7, "")], DOC))
    got = packing.pack_documents(docs, WORDS, ids=True)
    got = materialize(got, "test-packed")
    rows = got.collect()
    want = []
    for r in docs.collect():
        ids = [*EXACT.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4")
            want.append((str(r["doc_id"]), piece, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    bins = check_packing(rows, 2048)
    assert bins <= 1.01 * -(-sum(r["length"] for r in rows) // 2048) + 1
    # The sequences hold the ids of their pieces in place.
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(got).collect()}
    assert len(whole) == bins
    for r in rows:
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]


def test_sequences_at_shard_rims_are_packed_together(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 60)
    pieces = materialize(spark.range(700).selectExpr("id AS item", "30 AS length"), "test-pieces")
    rows = pieces.join(packing.pack(pieces, 300), "item").collect()
    assert sorted(r["item"] for r in rows) == list(range(700))
    assert check_packing(rows, 300) <= 71


def test_packing_nothing(spark):
    empty = spark.createDataFrame([], DOC)
    assert packing.pack_documents(empty, WORDS).count() == 0


def test_evolution_finds_full_bins():
    dice = random.Random(5)
    sizes = []
    for _ in range(150):
        a, b = sorted(dice.sample(range(1, 100), 2))
        sizes += [a, b - a, 100 - b]
    dice.shuffle(sizes)
    greedy = packing.first_packing(sizes, 100, 0.0, dice)
    labels, (bins, _) = packing.evolve(sizes, 100, [], 1)
    assert -bins <= len(greedy.bins)
    fill = collections.Counter()
    for label, size in zip(labels, sizes, strict=True):
        fill[label] += size
    assert max(fill.values()) <= 100 and len(fill) == -bins


def test_the_search_saves_bins_where_best_fit_is_far_off():
    for seed in range(3):
        dice, sizes = random.Random(seed), []
        for _ in range(400):
            a = dice.randint(380, 490)
            b = dice.randint(250, (1000 - a) // 2)
            sizes += [a, b, 1000 - a - b]
        first = len(packing.first_packing(sizes, 1000, 0.0, dice).bins)
        labels, (bins, _) = packing.evolve(sizes, 1000, [], seed)
        assert first > 1.1 * 400 and -bins == len(set(labels)) < 1.05 * 400


def test_words_by_rank_are_those_of_the_tokenizer():
    assert packing.never_made(WORDS) is not None
    dice = random.Random(8)
    letters = "etaoinshrdlucmfwypvbgkjqxzETAOaan"
    words = ["".join(dice.choices(letters, k=dice.randrange(1, 30))) for _ in range(20_000)] + ["a" * 500, "na" * 400]
    known = packing.WordIds(WORDS, packing.never_made(WORDS))
    for at in range(0, len(words), 500):
        text = " ".join(words[at : at + 500])
        (got,) = known.texts([text.encode()])
        assert np.frombuffer(got, "<u4").tolist() == EXACT.encode(text, add_special_tokens=False).ids


def test_few_words_are_remembered(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 50)
    known = packing.WordIds(WORDS, packing.never_made(WORDS))
    dice = random.Random(2)
    for _ in range(40):
        text = " ".join(dice.choice(["the,", "of", "été", "x|y"]) + f" w{dice.randrange(900)} k{'q' * dice.randrange(9)}." for _ in range(30))
        (got,) = known.texts([text.encode()])
        assert np.frombuffer(got, "<u4").tolist() == EXACT.encode(text, add_special_tokens=False).ids
        assert len(known) + len(known.before) <= 500


@given(st.lists(st.integers(1, 50), min_size=2, max_size=40), st.integers(0, 10_000))
@settings(max_examples=100, deadline=None)
def test_crossover_and_mutation_lose_nothing(sizes, seed):
    dice = random.Random(seed)
    a, b = (packing.first_packing(sizes, 50, noise, dice) for noise in (0.0, 0.5))
    child = packing.crossover(a, b, dice)
    packing.mutate(child, dice)
    assert sorted(i for items in child.bins.values() for i in items) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in items) == 50 - child.room[n] for n, items in child.bins.items())
    assert sorted(child.free) == child.free == sorted((r, n) for n, r in child.room.items())


def test_language_scores_match_the_base_and_beat_it(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    extra = spark.createDataFrame([(5, None), (5, None), (None, "of THE the"), (100_000, ""), (100_001, "x " * 20_000)], DOC)
    docs = docs.filter("doc_id >= 400").unionByName(extra)
    rows = docs.collect()
    tokens = [(r["doc_id"], [*(r["text"] or "").encode().lower().split(), None]) for r in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in tokens]
    c = collections.Counter(w for (_, ws), h in zip(tokens, held, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted(
        (str(d), h, len(ws), sum(w in c for w in ws), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 4))
        for (d, ws), h in zip(tokens, held, strict=True)
    )
    got = maxent_lm.language_scores(docs).collect()
    assert {r["train_tokens"] for r in got} == {n}
    assert want == sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in got)
    mine = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in mine) > sum(r["base_score"] for r in mine)


def test_language_scores_of_nothing(spark):
    empty = spark.createDataFrame([], DOC)
    assert maxent_lm.language_scores(empty, rounds=1).count() == 0
    lone = spark.createDataFrame([(d, "a b") for d in range(60) if zlib.crc32(str(d).encode()) % 7 == 2], DOC)
    rows = maxent_lm.language_scores(lone, rounds=1).collect()
    assert rows and all(r["base_score"] == 0 and r["n_known"] == 0 and r["score"] < 0 for r in rows)


def test_class_probabilities_add_up():
    weights = np.random.default_rng(1).normal(size=(maxent_lm.ROWS, maxent_lm.CLASSES)).astype(np.float32)
    rows = maxent_lm.features(np.arange(0, maxent_lm.CLASSES**3, 977))
    assert rows.min() >= 0 and rows.max() < maxent_lm.ROWS
    p = np.exp(maxent_lm.log_softmax(weights[rows].sum(axis=1)))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)


def test_histories_start_and_end_with_ends():
    text, now, code = maxent_lm.histories(np.array([1, 2, 3]), np.array([2, 0, 1]))
    e, k = maxent_lm.END, maxent_lm.CLASSES
    assert text.tolist() == [0, 0, 0, 1, 2, 2] and now.tolist() == [1, 2, e, e, 3, e]
    want = [(e, e, e), (e, e, 1), (e, 1, 2), (e, e, e), (e, e, e), (e, e, 3)]
    assert code.tolist() == [a * k * k + b * k + c for a, b, c in want]


def test_words_follow_the_words_before_them(spark):
    dice = random.Random(3)
    pairs = [(f"x{k}q", f"y{k}q") for k in range(120)]
    rows = [(d, " ".join("of %s %s of" % dice.choice(pairs) for _ in range(30))) for d in range(600)]
    held = [d for d in range(600, 800) if zlib.crc32(str(d).encode()) % 7 == 2][:2]
    order = dice.sample(range(120), 120)
    for d, shift in zip(held, (0, 1), strict=True):
        rows.append((d, " ".join(f"of x{k}q y{order[i - shift]}q of" for i, k in enumerate(order))))
    got = {r["doc_id"]: r for r in maxent_lm.language_scores(spark.createDataFrame(rows, DOC)).collect()}
    right, wrong = got[held[0]], got[held[1]]
    assert abs(right["base_score"] - wrong["base_score"]) < 1e-6
    assert (right["score"] - wrong["score"]) / 120 > 1


def word_model() -> maxent_lm.WordModel:
    dice = np.random.default_rng(2)
    types = np.array([*range(50), *(maxent_lm.TOP + dice.integers(0, maxent_lm.AFFIXES, 3_000))])
    lexicon = maxent_lm.Lexicon(np.sort(dice.integers(1, 2**63, len(types)).astype(np.uint64)), dice.integers(1, 90, len(types)), types)
    of = np.append(np.arange(maxent_lm.OWN), dice.integers(maxent_lm.END + 1, maxent_lm.CLASSES, maxent_lm.TOP + maxent_lm.AFFIXES - maxent_lm.OWN))
    rare = np.full(maxent_lm.CLASSES, 9.0)
    weights = dice.normal(size=(maxent_lm.ROWS, maxent_lm.CLASSES)).astype(np.float32)
    return maxent_lm.WordModel(maxent_lm.Model(lexicon, of, weights, maxent_lm.word_places(lexicon, of, rare), 1, 1, 1))


def every_word(model: maxent_lm.WordModel) -> np.ndarray:
    """The end, each word of the lexicon and the rest of each class, after one history."""
    places, of = model.model.words, model.model.class_of[model.model.lexicon.types]
    spare = np.arange(maxent_lm.END + 1, maxent_lm.CLASSES)
    own = np.arange(maxent_lm.END + 1)
    of, group, member = (np.concatenate(x) for x in zip((of[of > maxent_lm.END], places.group[of > maxent_lm.END], places.member[of > maxent_lm.END]), (spare, spare * 0, spare * 0), (own, own * 0, own * 0), strict=True))
    events = np.zeros(len(of), maxent_lm.EVENT)
    events["h"] = [7, 8, 9]
    events["code"], events["member"] = 1234 << 12 | of << 6 | group, member
    return events


def test_word_probabilities_add_up():
    model = word_model()
    for level in model.levels:
        level.weights[:] = np.random.default_rng(4).normal(size=level.weights.shape)
    assert np.isclose(np.exp(model.logs(every_word(model))).sum(), 1, atol=1e-4)


def test_word_weights_learn_and_grow_with_the_corpus():
    model = word_model()
    events = every_word(model)
    before = model.logs(events)[5]
    model.learn(np.repeat(events[5:6], 300))
    after = model.logs(events)
    assert after[5] > before + 1 and np.isclose(np.exp(after).sum(), 1, atol=1e-4)
    assert [maxent_lm.part_count(n) for n in (0, 1, maxent_lm.EVENTS + 1, 10 * maxent_lm.EVENTS)] == [1, 1, 2, 10]


def test_a_word_costs_as_many_choices_as_its_share_has_bits():
    places = word_model().model.words
    leaf = places.first[40]
    size = np.diff(places.begin)
    assert size.max() < 40 and size[leaf:places.first[41]].min() > 0
    mass = np.array([40.0, 30, 20, 6, 3, 1])
    leaf, choice, side, odds = maxent_lm.huffman(mass)
    steps = np.bincount(leaf)
    entropy = -(mass / 100 * np.log2(mass / 100)).sum()
    assert entropy <= (steps * mass).sum() / 100 <= entropy + 1
    log = np.where(side == 1, np.log(odds[choice]), 0) - np.log1p(odds[choice])
    assert np.allclose(np.exp(np.bincount(leaf, log)), mass / 100)


def test_learning_returns_what_scoring_gives_and_unknown_histories_add_nothing():
    model = word_model()
    events = np.repeat(every_word(model), 2)
    fresh = events[:50].copy()
    fresh["h"] = [50_000, 60_000, 61_000]
    before = model.logs(fresh)
    assert np.allclose(model.learn(events), model.logs(events), atol=1e-4)
    assert np.allclose(model.logs(fresh), before, atol=1e-6)


def test_first_words_are_dealt_to_several_parts():
    model = word_model().model
    many = dataclasses.replace(model, tokens=40 * maxent_lm.EVENTS, ends=10 * maxent_lm.EVENTS)
    n = 64
    batch = pa.RecordBatch.from_arrays(
        [pa.array([b""] * n, pa.binary()), pa.array(np.arange(n)), pa.array(np.arange(n)), pa.array([True] * n)], ["text", "k1", "k2", "learn"]
    )
    parts = [x for rows in maxent_lm._deal(many)(iter([batch])) for x in rows.column("part").to_pylist()]
    assert len(set(parts)) > 4


def test_words_are_read_as_python_splits_them():
    dice = random.Random(8)
    texts = [b"", b"  ", b" a\x0bB\x0c c\r\n\t d ", "Ä ä x\u00a0y \x1c z\x1cq".encode(), b"\xff\xfe b", b"x\x00y z"]
    texts += [bytes(dice.choices(b"abC \n\t\x0b\x0c\r\x1c\x85\xc3\xa4.Z", k=dice.randint(0, 40))) for _ in range(2_000)]
    hashes, affix, seen, sizes = maxent_lm.read_words(pa.array([b"left out", *texts], pa.binary())[1:])
    words = [w for t in texts for w in t.lower().split()]
    assert sizes.tolist() == [len(t.lower().split()) for t in texts]
    assert hashes[seen].tolist() == [xxhash.xxh3_64_intdigest(w) for w in words]
    assert affix[seen].tolist() == [zlib.crc32(w[-3:]) % maxent_lm.AFFIXES for w in words]


def test_dealt_tokens_are_whole_and_take_few_bytes():
    model, dice = word_model().model, np.random.default_rng(6)
    names = [b"w%d" % k for k in range(len(model.lexicon.hashes))]
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in names], np.uint64)
    names = [names[k] for k in np.argsort(hashes)]
    lexicon = dataclasses.replace(model.lexicon, hashes=np.sort(hashes))
    model = dataclasses.replace(model, lexicon=lexicon, tokens=3 * maxent_lm.EVENTS, ends=1)
    of = dict(zip(names, range(len(names)), strict=True))
    texts = [[names[k] for k in np.minimum(dice.zipf(1.3, 400), len(names)) - 1] + [b"rare%d" % d] for d in range(80)]
    texts += [[], []]
    learn, keys = [d % 3 > 0 for d in range(len(texts))], pa.array(range(len(texts)), pa.int64())
    columns = [pa.array([b" ".join(t) for t in texts], pa.binary()), keys, keys, pa.array(learn)]
    rows = pa.Table.from_batches(maxent_lm._deal(model)(iter([pa.RecordBatch.from_arrays(columns, ["text", "k1", "k2", "learn"])])))
    assert rows.num_rows == 3
    assert rows.nbytes < 9 * sum(len(t) + 1 for t in texts)
    symbols, numbers = maxent_lm._dealt(rows)
    events = maxent_lm._events(model, symbols)
    got = sorted((int(t), int(x) < maxent_lm.HELD, *map(int, e["h"]), int(e["code"]), int(e["member"])) for t, x, e in zip(numbers, symbols[:, 0], events, strict=True))
    end, want = (0, maxent_lm.END, 0, 0), []
    for d, words in enumerate(texts):
        known = []
        for w in words:
            h = int(maxent_lm.mix(np.array([xxhash.xxh3_64_intdigest(w)], np.uint64))[0] >> np.uint64(48))
            k = of.get(w)
            kind = lexicon.types[k] if k is not None else maxent_lm.TOP + zlib.crc32(w[-3:]) % maxent_lm.AFFIXES
            place = (0, 0) if k is None else (int(model.words.group[k]), int(model.words.member[k]))
            known.append((h, int(model.class_of[kind]), *place))
        known = [end] * 3 + known + [end]
        for three, two, one, now in zip(known, known[1:], known[2:], known[3:], strict=False):
            code = ((three[1] * 64 + two[1]) * 64 + one[1]) << 12 | now[1] << 6 | now[2]
            want.append((d, learn[d], one[0], two[0], three[0], code, now[3]))
    assert got == sorted(want)


def test_words_have_slots_of_their_own():
    words = np.repeat(np.arange(40), np.arange(40) ** 2).astype(np.uint16)
    layout = maxent_lm.Layout(words, 20, 0.9)
    cells = np.concatenate([layout.slots(np.full(5_000, w), np.arange(5_000) * 977) for w in range(1, 40)]).reshape(39, -1)
    ranges = sorted((int(x.min()), int(x.max())) for x in cells)
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:])) and ranges[-1][1] < layout.size <= 40 * len(words)


@pytest.mark.parametrize("size", [1, 3, 100])
def test_frequent_words_fit_their_bound(spark, size):
    counts = spark.createDataFrame([(i, i % 7, 1 + i // 3) for i in range(60)], "word bigint, affix bigint, n bigint")
    got = maxent_lm.frequent(counts, size)
    assert len(got.hashes) <= size and (np.diff(got.hashes.astype(object)) > 0).all()


def test_words_of_a_slice_are_merged_at_once():
    known = packing.WordIds(WORDS, packing.never_made(WORDS))
    dice = random.Random(5)
    signs = ["a", "B", "é", "È", "ß", "Ł", "ſ", "İ", "×", "÷", "Σ", "ς", "e\u0301", "1", ".", ",", "'", "'s", "!!", "%", "<|", "|>",
             "<|endoftext|>", "-", "中", "\u00a0", "\x01", "\x02", "\0", " ", " ", "\n", "\t", "\x1c", "the", "tion"]
    texts = ["", " ", "\x02", "x \x02", "\x01 y", "a\x02 \x02"]
    texts += ["".join(dice.choices(signs, k=dice.randint(1, 30))) for _ in range(3_000)]
    ids = [np.frombuffer(x, "<u4").tolist() for x in known.texts([x.encode() for x in texts])]
    slow = packing.WordIds(WORDS, None).texts([x.encode() for x in texts])
    assert ids == [np.frombuffer(x, "<u4").tolist() for x in slow]
    plain = [x for x in texts if not set(x) & {"\0", "\u00a0", "\x1c", "\x01", "\x02"}]
    for text, found in zip(texts, ids, strict=True):
        if text in plain:
            assert found == known.tokenizer.encode(text, add_special_tokens=False).ids, text
    known.forget()
    words = ["".join(dice.choices("abcdeéüñ", k=9)) for _ in range(2_000)]
    known.texts([" ".join(words).encode()])
    assert len(known) == 0  # no word was looked up or remembered
