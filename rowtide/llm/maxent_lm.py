"""A hashed maximum-entropy language model with a class-factored softmax.

``P(word | history) = P(class | history) * P(word | class, history)``.

* Words fall into ``CLASSES`` classes: the most frequent ones have one of their
  own, as the end of a text has; the others are clustered by the frequent words
  near them, rare words through their last bytes.
* The class is predicted by a softmax over features of the last three classes
  (single, skipped, pairs, a skipped pair and the triple, hashed into a table
  with a block of slots for each last class) and of the last three words
  themselves: n-grams and skips, hashed into slots (:func:`word_keys`).
* The word is predicted within its class by the same features of words. Without
  weights each has its smoothed share of the class's tokens. Words that are not
  among the frequent ones are predicted as one, in which they have their shares.

Where features of words take part, a softmax is a path of choices between two
branches of a Huffman tree, so a token costs as many steps as its word has bits:
through the classes, then through the words of the class. Each choice has weights
of its own for all features, on top of the odds that the class weights or the
shares give it. Products of the choices add up to 1 over all words.

All statistics cover all training texts: word counts, neighbours of words, and
how often each class follows each history. Weights of classes are fitted to the
latter by distributed gradient updates: tasks return the gradient of their
histories, the driver adds them up.

Weights of words are dealt out by the last word (a frequent one also by the two
before it, first words by their text) to parts of about ``EVENTS`` tokens, each with ``1 << SLOT_BITS`` slots
for each feature, so the table grows with the corpus. No slot is used by two
parts: gradients are added up by slot within a Spark group, and the weights stay
there. A round updates one feature after the other, each on top of those before
it. The same group scores the tokens dealt to it, where a history that it has not
learned from adds nothing.
"""

from __future__ import annotations

import ctypes
import heapq
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from rowtide.llm.batches import text_slices
from rowtide.llm.common import drop_table, finished_shuffles_go, fold_of, materialize, release
from rowtide.llm.shingles import mix
from rowtide.session import ship

HEAD = 65_536
TOP = 512
AFFIXES = 512
OWN = 31
CLASSES = 64
ANCHORS = 32
END = OWN  # the class of the end of a text
SLOTS = 256
ROUNDS = 12
LIMIT = 0.4
FEATURES = 7
EVENTS = 2**19
SLOT_BITS = 22
GROUPS = 64
WORD_FEATURES = 5
WORD_ROUNDS = 2
WORD_LIMIT = 3.0
WORD_PRIOR = 3.0
CHUNK = 16_384
PAIRS = 65_536
HISTORIES = 65_536
CODE_BYTES = 8_000_000
ENTRIES = 2**19
EVENT = np.dtype([("h", "<u2", 3), ("code", "<u4"), ("member", "<u2")])
CODEC = pa.Codec("zstd", compression_level=1)
CODED = ("slice", "words", "affixes", "seen", "sizes", "learn")


def affixes(names: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of the last three bytes of each word, modulo ``AFFIXES``."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    out = np.full(len(begin), 0xFFFFFFFF, np.uint32)
    for back in (3, 2, 1):
        there = np.flatnonzero(end - begin >= back)
        now = out[there]
        out[there] = table.take((now ^ names[end[there] - back]) & 0xFF) ^ (now >> 8)
    return (~out % np.uint32(AFFIXES)).astype(np.int64)


def read_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and affix of each distinct word, A-Z in lower case, the words of all texts as numbers of those, and their count by text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    sizes, words = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()
    full = pc.greater(pc.binary_length(words), 0)
    if pc.any(pc.invert(full)).as_py():  # white space at either end of a text
        sizes -= np.bincount(np.repeat(np.arange(len(sizes)), sizes)[~full.to_numpy(zero_copy_only=False)], minlength=len(sizes))
        words = words.filter(full)
    coded = words.dictionary_encode()
    distinct = coded.dictionary
    if not len(distinct):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32), sizes
    _, offsets, names = distinct.buffers()
    offsets = np.frombuffer(offsets, np.int32, len(distinct) + 1, 4 * distinct.offset).astype(np.int64)
    data, places = names.to_pybytes(), offsets.tolist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, (data[a:b] for a, b in pairwise(places))), np.uint64, len(distinct))
    return hashes, affixes(np.frombuffer(data, np.uint8), offsets[:-1], offsets[1:]), coded.indices.to_numpy(), sizes


@dataclass(frozen=True)
class Lexicon:
    """The frequent words: sorted hashes, counts, and the type of each (its rank, or its affix's number)."""

    hashes: np.ndarray
    counts: np.ndarray
    types: np.ndarray

    def places(self, words: Slice) -> tuple[np.ndarray, np.ndarray]:
        """For each word of a slice where it is, and whether it is there at all."""
        at = np.searchsorted(self.hashes, words.hash)
        at[at == len(self.hashes)] = 0
        return at, self.hashes[at] == words.hash if len(self.hashes) else np.zeros(len(at), bool)

    def find(self, words: Slice) -> tuple[np.ndarray, np.ndarray]:
        """For each word of a slice its count (-1: not among the frequent) and its type."""
        at, known = self.places(words)
        count, kind = np.full(len(at), -1, np.int64), TOP + words.affix
        if len(self.hashes):
            count[known] = self.counts[at[known]]
            ranked = known.copy()
            ranked[known] = self.types[at[known]] < TOP
            kind[ranked] = self.types[at[ranked]]
        return count, kind


@dataclass(frozen=True)
class Places:
    """Where the frequent words stand in their classes, and the choices that lead to each."""

    group: np.ndarray  # by place in the lexicon; group 0 holds the words that are not in it
    member: np.ndarray
    first: np.ndarray  # by class: its first leaf, which is group 0; the members of the groups follow
    begin: np.ndarray  # by leaf: where its choices begin; one more at the end
    choice: np.ndarray  # the choices of each leaf; the first CLASSES - 1 are between classes
    side: np.ndarray  # 1 where the leaf is in the second branch
    start: np.ndarray  # by choice: odds without weights, as a logarithm; 0 between classes
    branches: np.ndarray  # 2 x choices between classes x CLASSES: which classes are in either branch
    rare: np.ndarray  # by class: log10 of what the count + 1 of a word in group 0 is divided by


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    class_of: np.ndarray  # by type
    weights: np.ndarray
    words: Places
    tokens: int
    vocabulary: int
    ends: int


def trim() -> None:
    """Give free memory back to the system, now and as soon as a large array goes: a JVM beside this worker needs its own.

    Without that, the C library keeps what arrays of some MB have left for others.
    """
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):
        library = ctypes.CDLL(None)
        library.mallopt(-3, 1 << 22)  # M_MMAP_THRESHOLD
        library.malloc_trim(0)


def compressed(planes: np.ndarray) -> bytes:
    return CODEC.compress(np.ascontiguousarray(planes), asbytes=True)


def pack(x: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes, the lowest first."""
    return x.nbytes.to_bytes(8, "little") + compressed(x.view(np.uint8).reshape(len(x), x.itemsize).T)


def unpack(data: pa.Buffer | bytes, kind: str) -> np.ndarray:
    data = pa.py_buffer(data)
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(CODEC.decompress(data[8:], size), np.uint8) if size else np.empty(0, np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).reshape(-1).view(kind)


@dataclass
class Slice:
    """Some texts as numbers of the words in a dictionary of their own."""

    number: int
    hash: np.ndarray  # by word, ascending
    affix: np.ndarray
    seen: np.ndarray  # the words of all texts
    sizes: np.ndarray  # words by text
    more: dict[str, pa.Array]  # other columns, by text

    def learned(self) -> np.ndarray:
        """Whether each text is one to learn from."""
        return self.more["learn"].to_numpy(zero_copy_only=False)

    def training(self) -> tuple[np.ndarray, np.ndarray]:
        """Words and sizes of the texts to learn from."""
        learn = self.learned()
        return self.seen[np.repeat(learn, self.sizes)], self.sizes[learn]


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each :class:`Slice` of texts (text, and columns to keep)."""
    task, made = TaskContext.get(), 0
    first = (task.partitionId() if task else 0) << 32
    for batch in text_slices(batches, CODE_BYTES):
        hashes, affix, seen, sizes = read_words(batch.column("text"))
        order = np.argsort(hashes)
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order))
        more = [x for x in batch.schema.names if x != "text"]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([first + made]),
                pa.array([hashes[order].tobytes()], pa.binary()),
                pa.array([pack(affix[order].astype(np.uint16))], pa.binary()),
                pa.array([pack(number.take(seen))], pa.binary()),
                pa.array([pack(sizes.astype(np.int32))], pa.binary()),
                *(pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(x)) for x in more),
            ],
            ["slice", "words", "affixes", "seen", "sizes", *more],
        )
        made += 1
    trim()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
    """The slices of coded texts, or of texts that are not coded yet."""
    for batch in batches:
        for rows in _coded(iter([batch])) if "text" in batch.schema.names else [batch]:
            for i in range(rows.num_rows):
                row = {x: rows.column(x)[i] for x in rows.schema.names}
                yield Slice(
                    row.pop("slice").as_py(),
                    np.frombuffer(row.pop("words").as_buffer(), np.uint64) if "words" in row else np.empty(0, np.uint64),
                    unpack(row.pop("affixes").as_buffer(), "<u2").astype(np.int64),
                    unpack(row.pop("seen").as_buffer(), "<i4"),
                    unpack(row.pop("sizes").as_buffer(), "<i4").astype(np.int64),
                    {k: x.values if x.is_valid else pa.nulls(0) for k, x in row.items()},
                )


def code_texts(docs: DataFrame, learn: Column) -> DataFrame:
    """The texts of ``docs`` (doc_id, text) as slices: the words of each are told apart, hashed and numbered once."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        text.cast("binary").alias("text"),
        "doc_id",
        F.xxhash64(text).alias("k1"),
        F.xxhash64(text, F.lit(1)).alias("k2"),
        learn.alias("learn"),
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _coded,
        "slice bigint, words binary, affixes binary, seen binary, sizes binary, "
        f"doc_id array<{kind}>, k1 array<bigint>, k2 array<bigint>, learn array<boolean>",
    )


def count_words(coded: DataFrame) -> DataFrame:
    """How often each word occurs in the texts to learn from, counted in buckets of hashes.

    A row for each bucket with its words (``slice`` null), and one for each slice
    in it: the counts of the slice's words, in the order of their hashes.
    """
    entries = coded.select(F.sum(F.octet_length("words")).alias("n")).first()["n"] or 0
    buckets = np.uint64(max(1, -(-entries // (8 * ENTRIES))))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _slices(batches):
            n = np.bincount(s.training()[0], minlength=len(s.hash))
            used, first = np.unique(((s.hash >> np.uint64(32)) * buckets) >> np.uint64(32), return_index=True)
            cuts = list(zip(first, np.append(first, len(n))[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used.astype(np.int32)),
                    pa.array([s.number] * len(used), pa.int64()),
                    pa.array([s.hash[a:b].tobytes() for a, b in cuts], pa.binary()),
                    pa.array([pack(s.affix[a:b].astype(np.uint16)) for a, b in cuts], pa.binary()),
                    pa.array([pack(n[a:b]) for a, b in cuts], pa.binary()),
                ],
                ["bucket", "slice", "words", "affixes", "n"],
            )

    def count(table: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("words")]
        word, ends = np.concatenate(hashes), np.cumsum([len(x) for x in hashes])
        affix = np.concatenate([unpack(x.as_buffer(), "<u2") for x in table.column("affixes")])
        n = np.concatenate([unpack(x.as_buffer(), "<i8") for x in table.column("n")])
        order = np.argsort(word)
        first = np.append(True, word[order][1:] != word[order][:-1])
        begin = np.flatnonzero(first)
        total = np.add.reduceat(n[order], begin)
        all_n = np.empty(len(word), np.int64)
        all_n[order] = total[np.cumsum(first) - 1]
        own = [pack(x) for x in np.split(all_n, ends[:-1])]
        met = total > 0
        vocabulary = order[begin][met]
        return pa.table(
            {
                "bucket": pa.array([table.column("bucket")[0].as_py()] * (len(own) + 1), pa.int32()),
                "slice": pa.array([*table.column("slice").to_pylist(), None], pa.int64()),
                "words": pa.array([None] * len(own) + [word[vocabulary].tobytes()], pa.binary()),
                "affixes": pa.array([None] * len(own) + [pack(affix[vocabulary])], pa.binary()),
                "n": pa.array([*own, pack(total[met])], pa.binary()),
            }
        )

    schema = "bucket int, slice bigint, words binary, affixes binary, n binary"
    return coded.select("slice", "words", "affixes", "seen", "sizes", "learn").mapInArrow(send, schema).groupBy("bucket").applyInArrow(count, schema)


def words_counted(counted: DataFrame) -> DataFrame:
    """``word, affix, n``: a hash of each distinct word, its affix, and its count."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, affixes, n in zip(*(batch.column(x) for x in ("words", "affixes", "n")), strict=True):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(words.as_buffer(), np.int64)),
                        pa.array(unpack(affixes.as_buffer(), "<u2").astype(np.int64)),
                        pa.array(unpack(n.as_buffer(), "<i8")),
                    ],
                    ["word", "affix", "n"],
                )

    return counted.filter(F.col("slice").isNull()).select("words", "affixes", "n").mapInArrow(rows, "word bigint, affix bigint, n bigint")


def frequent(counts: DataFrame, size: int = HEAD) -> Lexicon:
    """Words of the highest counts, ``size`` at most: all that have a count that so many words reach."""
    level = F.floor(F.log2("n") * 16).cast("int")
    levels = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    total, least = 0, None
    for r in levels:
        total += r["count"]
        if total > size:
            break
        least = r["level"]
    rows = [] if least is None else counts.filter(level >= least).collect()
    rows.sort(key=lambda r: (-r["n"], r["word"]))
    types = np.array([k if k < TOP else TOP + r["affix"] for k, r in enumerate(rows)], np.int64)
    hashes = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Lexicon(hashes[order], np.array([r["n"] for r in rows], np.int64)[order], types[order])


def neighbours(coded: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """How often each type stands one or two words from each of the most frequent words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((TOP + AFFIXES) * ANCHORS, np.int64)
        for s in _slices(batches):
            seen, sizes = s.training()
            kind = lexicon.find(s)[1].astype(np.int32).take(seen)
            text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            anchor = np.flatnonzero(kind < ANCHORS)
            for lag in (1, 2):
                for near, one in ((anchor, anchor + lag), (anchor, anchor - lag)):
                    inside = (one >= 0) & (one < len(kind))
                    near, one = near[inside], one[inside]
                    same = text.take(near) == text.take(one)
                    total += np.bincount(kind.take(one[same]) * ANCHORS + kind.take(near[same]), minlength=len(total))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    counted = coded.select(*CODED).mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros((TOP + AFFIXES) * ANCHORS)
    for r in counted.collect():
        out[r["cell"]] = r["n"]
    return out.reshape(TOP + AFFIXES, ANCHORS)


def classes(near: np.ndarray) -> np.ndarray:
    """The class of each type: ranks below ``OWN`` have their own, the others are clustered by their neighbours."""
    weight = near.sum(axis=1)
    x = np.sqrt(near / np.maximum(weight, 1)[:, None])
    rest = np.arange(OWN, len(near))
    x, weight = x[rest], weight[rest]
    k = CLASSES - OWN - 1
    dice = np.random.default_rng(7)
    centres = [x[int(weight.argmax())]]
    for _ in range(k - 1):
        far = np.min([((x - c) ** 2).sum(axis=1) for c in centres], axis=0) * weight
        centres.append(x[dice.choice(len(x), p=far / far.sum())] if far.sum() > 0 else x[0])
    centre = np.array(centres)
    for _ in range(20):
        label = ((x[:, None, :] - centre[None]) ** 2).sum(axis=2).argmin(axis=1)
        for c in range(k):
            if weight[label == c].sum() > 0:
                centre[c] = np.average(x[label == c], axis=0, weights=weight[label == c])
    out = np.arange(len(near))
    out[rest] = END + 1 + label
    return out


def histories(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, next classes and coded histories of the last three, from the classes of all words.

    Each text ends with the class of its end; before its first word stand ends.
    """
    texts = len(sizes)
    text = np.repeat(np.arange(texts), sizes + 1)
    now = np.full(len(words) + texts, END, np.int64)
    place = np.arange(len(text)) - (np.cumsum(sizes + 1) - sizes - 1)[text]
    now[place < sizes[text]] = words
    code = np.zeros(len(now), np.int64)
    for lag in (3, 2, 1):
        before = np.full(len(now), END, np.int64)
        before[lag:] = now[:-lag] if len(now) > lag else 0
        before[place < lag] = END
        code = code * CLASSES + before
    return text, now, code


def features(history: np.ndarray) -> np.ndarray:
    """The weight rows of coded histories: bias, two skips, and four in the block of the last class."""
    third, second, last = history // CLASSES**2, history // CLASSES % CLASSES, history % CLASSES
    block = 1 + 2 * CLASSES + last * SLOTS

    def slot(kind: int, x: np.ndarray) -> np.ndarray:
        hashed = (x + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(kind * 0xC2B2AE3D27D4EB4F % 2**64)
        return block + 1 + ((hashed ^ (hashed >> np.uint64(29))) >> np.uint64(7)).astype(np.int64) % (SLOTS - 1)

    return np.stack(
        [
            np.zeros_like(history),
            1 + second,
            1 + CLASSES + third,
            block,
            slot(1, second),
            slot(2, third),
            slot(3, second * CLASSES + third),
        ],
        axis=1,
    )


ROWS = 1 + 2 * CLASSES + CLASSES * SLOTS


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def class_counts(coded: DataFrame, lexicon: Lexicon, class_of: np.ndarray) -> DataFrame:
    """How often each class follows each history: a row for each last class, with the cells of :func:`features`' histories in it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**4, np.int32)
        for s in _slices(batches):
            seen, sizes = s.training()
            _, now, code = histories(class_of[lexicon.find(s)[1]].take(seen), sizes)
            cell = ((code % CLASSES) * CLASSES**2 + code // CLASSES) * CLASSES + now
            np.add.at(total, cell, np.int32(1))
        for last, block in enumerate(total.reshape(CLASSES, -1)):
            cells = np.flatnonzero(block).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([last], pa.int32()), pa.array([pack(cells)], pa.binary()), pa.array([pack(block[cells])], pa.binary())],
                ["last", "cells", "n"],
            )
        del total, block
        trim()

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(CLASSES**3, np.int64)
        for cells, n in zip(table.column("cells"), table.column("n"), strict=True):
            total[unpack(cells.as_buffer(), "<i4")] += unpack(n.as_buffer(), "<i4")
        cells = np.flatnonzero(total).astype(np.int32)
        return pa.table(
            {
                "last": pa.array([table.column("last")[0].as_py()], pa.int32()),
                "cells": pa.array([pack(cells)], pa.binary()),
                "n": pa.array([pack(total[cells])], pa.binary()),
            }
        )

    schema = "last int, cells binary, n binary"
    return coded.select(*CODED).mapInArrow(count, schema).groupBy("last").applyInArrow(add, schema)


def fit_weights(table: DataFrame, often: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Gradient updates of the weights, each scaled by the curvature of its cell.

    Starts from how often each class occurs. A step is shared among the features
    of a history, so that together they do not overshoot.
    """
    weights = np.zeros((ROWS, CLASSES), np.float32)
    weights[0] = np.log(often + 1)
    for _ in range(rounds):

        def gradient(batches: Iterator[pa.RecordBatch], weights=weights) -> Iterator[pa.RecordBatch]:
            g, h = np.zeros((ROWS, CLASSES)), np.zeros((ROWS, CLASSES))
            for b in batches:
                for last, cells, n in zip(*(b.column(x) for x in ("last", "cells", "n")), strict=True):
                    seen = np.zeros(CLASSES**3)
                    seen[unpack(cells.as_buffer(), "<i4")] = unpack(n.as_buffer(), "<i8")
                    seen = seen.reshape(-1, CLASSES)
                    there = np.flatnonzero(seen.any(axis=1))
                    seen, rows = seen[there], features(there * CLASSES + last.as_py())
                    p = np.exp(log_softmax(sum(weights.take(x, axis=0) for x in rows.T)))
                    total = seen.sum(axis=1, keepdims=True)
                    seen -= total * p
                    curve = total * p * (1 - p)
                    for x in rows.T if len(there) else ():
                        order = np.argsort(x, kind="stable")
                        first = np.flatnonzero(np.append(True, np.diff(x[order])))
                        g[x[order][first]] += np.add.reduceat(seen[order], first)
                        h[x[order][first]] += np.add.reduceat(curve[order], first)
            used = np.flatnonzero(h.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes()], pa.binary()) for x in (used, g[used].astype(np.float32), h[used].astype(np.float32))],
                ["rows", "g", "h"],
            )

        g, h = np.zeros((ROWS, CLASSES)), np.zeros((ROWS, CLASSES))
        for r in table.mapInArrow(gradient, "rows binary, g binary, h binary").toLocalIterator():
            used = np.frombuffer(r["rows"], np.int64)
            g[used] += np.frombuffer(r["g"], np.float32).reshape(-1, CLASSES)
            h[used] += np.frombuffer(r["h"], np.float32).reshape(-1, CLASSES)
        pull = 0.1 * weights
        pull[0] = 0
        weights = (weights + np.clip((g - pull) / (h + 1.0) / FEATURES, -LIMIT, LIMIT)).astype(np.float32)
    return weights


def train(coded: DataFrame, counts: DataFrame, rounds: int = ROUNDS) -> Model:
    """Fit the model to the texts to learn from, whose word counts are ``counts`` (:func:`words_counted`)."""
    ends = coded.select(F.explode("learn").alias("learn")).filter("learn").count()
    sums = counts.groupBy("affix").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    lexicon = frequent(counts)
    class_of = classes(neighbours(coded, lexicon))
    n, v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in sums:
        n[class_of[TOP + r["affix"]]] += r["n"]
        v[class_of[TOP + r["affix"]]] += 1 * r["v"]
    # The ranked words are counted with their affix so far.
    ranked = lexicon.types < TOP
    if ranked.any():
        affixes = {r["word"]: r["affix"] for r in counts.filter(F.col("word").isin([int(x) for x in lexicon.hashes[ranked].view(np.int64)])).collect()}
        for word, count, kind in zip(lexicon.hashes[ranked].view(np.int64), lexicon.counts[ranked], lexicon.types[ranked], strict=True):
            was, now = class_of[TOP + affixes[int(word)]], class_of[kind]
            n[was], v[was] = n[was] - count, v[was] - 1
            n[now], v[now] = n[now] + count, v[now] + 1
    of = class_of[lexicon.types]
    rare = n - np.bincount(of, lexicon.counts, CLASSES) + v - np.bincount(of, minlength=CLASSES) + 1
    tokens, vocabulary = sum(r["n"] for r in sums) + ends, sum(r["v"] for r in sums) + (ends > 0)
    often = n.copy()
    often[END] = ends
    table = materialize(class_counts(coded, lexicon, class_of), "lm-histories")
    weights = fit_weights(table, often, rounds)
    drop_table(table)
    return Model(lexicon, class_of, weights, word_places(lexicon, class_of, rare, ends), tokens, vocabulary, ends)


def huffman(mass: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The choices of a Huffman tree: leaf, choice and side of each step to a leaf, and the odds of each choice's second side."""
    heap = [(float(m), k) for k, m in enumerate(mass)]
    n = len(heap)
    up, side, odds = np.zeros(2 * n, np.int64), np.zeros(2 * n, np.int8), np.zeros(max(n - 1, 0))
    heapq.heapify(heap)
    for k in range(n - 1):
        (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
        up[left] = up[right] = n + k
        side[right], odds[k] = 1, b / a
        heapq.heappush(heap, (a + b, n + k))
    leaf = at = np.arange(n if n > 1 else 0)
    steps = []
    while len(leaf):
        steps.append((leaf, up[at] - n, side[at]))
        below = up[at] < 2 * n - 2
        leaf, at = leaf[below], up[at][below]
    parts = [np.concatenate(x) for x in zip(*steps, strict=True)] or [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int8)]
    return parts[0], parts[1], parts[2], odds


def word_places(lexicon: Lexicon, class_of: np.ndarray, rare: np.ndarray, ends: int = 0) -> Places:
    """Deal the frequent words of each class out to its groups and lay out the choices that lead to them.

    ``rare``: counts + 1 of all other words of each class, and 1; ``ends``: how many texts end.
    """
    of = class_of[lexicon.types]
    group, member = np.zeros(len(of), np.int64), np.zeros(len(of), np.int64)
    rest = np.maximum(rare, 1)
    mass = np.bincount(of, lexicon.counts + 1, CLASSES) + rest
    mass[END] += ends
    leaf, choice, side, _ = huffman(mass)
    branches = np.zeros((2, CLASSES - 1, CLASSES), np.float32)
    branches[side, choice, leaf] = 1
    steps, start, first, leaves = [], [np.zeros(CLASSES - 1)], np.zeros(CLASSES, np.int64), 0
    for c in range(CLASSES):
        mine = np.flatnonzero(of == c) if c > END else np.empty(0, np.int64)
        mine = mine[np.argsort(-lexicon.counts[mine], kind="stable")]
        rank = np.arange(len(mine))
        group[mine], member[mine] = 1 + rank % (GROUPS - 1), rank // (GROUPS - 1)
        first[c] = leaves
        at, path, way, odds = huffman(np.append(rest[c], lexicon.counts[mine] + 1))
        steps.append((leaves + at, sum(map(len, start)) + path, way))
        start.append(np.log(odds))
        own = leaf == c
        all_leaves = leaves + np.arange(len(mine) + 1)
        steps.append((np.repeat(all_leaves, own.sum()), np.tile(choice[own], len(all_leaves)), np.tile(side[own], len(all_leaves))))
        leaves += len(all_leaves)
    leaf, choice, side = (np.concatenate(x) for x in zip(*steps, strict=True))
    order = np.argsort(leaf, kind="stable")
    begin = np.append(0, np.cumsum(np.bincount(leaf, minlength=leaves)))
    return Places(
        group,
        member,
        first,
        begin,
        choice[order].astype(np.int32),
        side[order],
        np.concatenate(start).astype(np.float32),
        branches,
        np.log10(rest),
    )


def word_keys(h: np.ndarray, feature: int) -> np.ndarray:
    """A feature of the hashes of the last three words, the last first: 1-, 2- or 3-gram, or one of two that skip words."""
    one, two, three = (h[:, k].astype(np.uint64) for k in range(3))
    kinds = (lambda: one, lambda: two, lambda: two << 16 | one, lambda: three << 32 | one, lambda: three << 32 | two << 16 | one)
    return kinds[feature]() | np.uint64(feature << 48)


#: Layouts of slots: which of the last words has them, and how their number grows with its tokens (a word has but one history alone).
LAYOUTS = ((0, 24, 0.8), (1, 24, 0.8), (0, 20, 0.9))
#: The layout of each feature.
LAID = (0, 1, 2, 2, 2)


def word_slots(keys: np.ndarray) -> np.ndarray:
    """Hashes of features, or of choices; a feature of a choice has the slot that the two make by exclusive or."""
    out = np.empty(len(keys), np.int32)
    for a in range(0, len(keys), CHUNK):
        out[a : a + CHUNK] = mix(keys[a : a + CHUNK].astype(np.uint64) + np.uint64(1)) >> np.uint64(64 - SLOT_BITS)
    return out


@dataclass(frozen=True)
class Path:
    """Choices on the way to the words of some tokens."""

    begin: np.ndarray  # by token: where its choices begin; one more at the end
    slot: np.ndarray  # the hash of the choice
    side: np.ndarray  # 1 where the second branch was taken
    logit: np.ndarray  # of the second branch; without weights at first


class Layout:
    """Where the slots of each word are, by its hash: about ``first * tokens ** power``, a power of two.

    Words with more tokens, and so more slots, stand first.
    """

    def __init__(self, words: np.ndarray, first: float, power: float) -> None:
        n = np.bincount(words, minlength=1 << 16)
        self.there = n > 0
        bits = np.clip(np.rint(np.log2(first * np.maximum(n, 1) ** power)), 3, SLOT_BITS).astype(np.int64)
        self.cells = np.where(self.there, 1 << bits, 0)
        order = np.argsort(-n, kind="stable")
        cells = self.cells[order]
        self.rank, self.base = np.empty(len(n), np.uint16), np.empty(len(n), np.int64)
        self.rank[order] = np.arange(len(n))
        self.base[order] = np.where(cells > 0, np.cumsum(cells) - cells, 0)
        self.size, self.mask = int(cells.sum()), np.maximum(self.cells - 1, 0).astype(np.int32)

    def sorted(self, words: np.ndarray) -> np.ndarray:
        return np.argsort(self.rank.take(words), kind="stable")

    def slots(self, words: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """What makes the slots of the features of some tokens, by exclusive or with their masked choices."""
        return self.base.take(words) ^ (keys & self.mask.take(words))


class Turn:
    """The tokens of a path in the order of a layout.

    Words that have as many slots, or parts of one, go together: what they touch fits a processor's cache.
    """

    def __init__(self, layout: Layout, words: np.ndarray, path: Path, order: np.ndarray | None = None) -> None:
        """``order``: of the tokens, if the path has another."""
        self.layout, self.order = layout, order
        sizes = np.diff(path.begin).astype(np.int32)
        self.words, self.sizes, ends = words, sizes, path.begin
        if order is not None:
            self.words, self.sizes = words[order], sizes[order]
            ends = np.append(0, np.cumsum(self.sizes, dtype=np.int64))
            self.shift = path.begin[order] - ends[:-1]
        # Each chunk: first token, end, mask, first slot, end, and the ends of its steps.
        self.ends, self.chunks = ends, []
        groups = np.append(np.flatnonzero(np.append(True, self.words[1:] != self.words[:-1])), len(self.words))
        heads, after, masks = self.words[groups[:-1]], ends[groups], layout.mask.take(self.words[groups[:-1]])
        changes = np.append(np.flatnonzero(masks[1:] != masks[:-1]) + 1, len(heads))
        first = 0
        while first < len(heads):
            last = max(first + 1, int(np.searchsorted(after, after[first] + PAIRS, side="right")) - 1)
            last = min(last, int(changes[np.searchsorted(changes, first, side="right")]))
            steps, end = [int(groups[first])], int(groups[last])
            while steps[-1] < end:
                until = int(np.searchsorted(ends, ends[steps[-1]] + PAIRS, side="right")) - 1
                steps.append(min(end, max(steps[-1] + 1, until)))
            low, high = int(layout.base[heads[first]]), int(layout.base[heads[last - 1]] + layout.cells[heads[last - 1]])
            self.chunks.append((masks[first], low, high, steps))
            first = last

    def pairs(self, a: int, b: int) -> slice | np.ndarray:
        """Where the choices of some tokens are in the path."""
        low, high = self.ends[a], self.ends[b]
        return slice(low, high) if self.order is None else np.repeat(self.shift[a:b], self.sizes[a:b]) + np.arange(low, high)


class Choices:
    """Choices between two branches by hashed features of words: a weight for each slot of each feature."""

    def __init__(self) -> None:
        self.deal(np.empty((0, 2), np.uint16))
        self.weights = np.zeros(WORD_FEATURES, np.float32)

    def deal(self, h: np.ndarray) -> None:
        """Give slots to the words of some histories."""
        self.layouts = [Layout(h[:, k], first, power) for k, first, power in LAYOUTS]
        self.weights = np.zeros(int(self.begins()[-1]), np.float32)

    def begins(self) -> np.ndarray:
        """Where the weights of each feature begin; one more at the end."""
        return np.cumsum([0, *(max(1, self.layouts[k].size) for k in LAID)])

    def of(self, feature: int) -> np.ndarray:
        return self.weights[self.begins()[feature] : self.begins()[feature + 1]]

    def update(self, feature: int, keys: np.ndarray, turn: Turn, path: Path) -> None:
        """One gradient update of the weights of a feature, scaled by the curvature of each cell, and of the logits."""
        all_weights, slots = self.of(feature), turn.layout.slots(turn.words, keys if turn.order is None else keys[turn.order])
        most = max(turn.ends[b] - turn.ends[a] for _, _, _, steps in turn.chunks for a, b in zip(steps, steps[1:], strict=False))
        space = [np.empty(most, kind) for kind in (np.intp, np.float32, np.float32, np.float32)]
        cells = max(high - low for _, low, high, _ in turn.chunks)
        tables = [np.empty(cells, np.float32) for _ in range(3)]
        for mask, low, high, steps in turn.chunks:
            gap, curve, pull = (x[: high - low] for x in tables)
            gap.fill(0)
            curve.fill(WORD_PRIOR)
            done = []
            for a, b in zip(steps, steps[1:], strict=False):
                here = turn.pairs(a, b)
                at, x, p, q = (y[: turn.ends[b] - turn.ends[a]] for y in space)
                if turn.order is None:
                    x, slot, side = path.logit[here], path.slot[here], path.side[here]
                else:
                    x, slot, side = path.logit.take(here, out=x, mode="wrap"), path.slot.take(here), path.side.take(here)
                np.bitwise_and(slot, mask, out=at, casting="same_kind")
                at ^= np.repeat(slots[a:b] - low, turn.sizes[a:b])
                np.negative(x, out=p)
                np.exp(p, out=p)
                p += 1
                np.reciprocal(p, out=p)
                np.subtract(side, p, out=q)
                np.add.at(gap, at, q)
                np.multiply(p, p, out=q)
                p -= q
                np.add.at(curve, at, p)
                done.append((here, x, at) if len(steps) == 2 else (here, x if turn.order is None else x.copy(), at.copy()))
            weights = all_weights[low:high]
            gap -= np.multiply(weights, np.float32(0.1), out=pull)
            gap /= curve
            np.clip(gap, -WORD_LIMIT, WORD_LIMIT, out=gap)
            weights += gap
            for here, x, at in done:
                x += gap.take(at, mode="wrap", out=space[2][: len(at)])
                if turn.order is not None:
                    path.logit[here] = x


class Ways:
    """The choices that lead to words, as they are without weights of words."""

    def __init__(self, model: Model) -> None:
        self.model, places = model, model.words
        self.slot = word_slots(np.arange(len(places.start))).take(places.choice)
        self.start = places.start.take(places.choice)
        self.between = np.where(places.choice < CLASSES - 1, places.choice, np.int32(-1))
        self.forget()

    def forget(self) -> None:
        self.row = np.full(CLASSES**3, -1, np.int32)  # of class histories seen so far
        self.odds = np.empty((0, CLASSES - 1), np.float32)

    def see(self, history: np.ndarray) -> None:
        """Work out once for each class history the odds of the choices between classes."""
        if len(self.odds) > HISTORIES:
            self.forget()
        there = np.zeros(CLASSES**3, bool)
        there[history] = True
        new = np.flatnonzero(there & (self.row < 0))
        self.row[new] = len(self.odds) + np.arange(len(new))
        found = [self.odds]
        for begin in range(0, len(new), CHUNK):
            rows = features(new[begin : begin + CHUNK])
            p = np.exp(log_softmax(sum(self.model.weights[rows[:, f]] for f in range(FEATURES))))
            left, right = (np.log(np.maximum(p @ side.T, 1e-30)) for side in self.model.words.branches)
            found.append((right - left).astype(np.float32))
        self.odds = np.concatenate(found)

    def path(self, events: np.ndarray) -> Path:
        places, code = self.model.words, events["code"].astype(np.int64)
        self.see(code >> 12)
        leaf = places.first[code >> 6 & 63] + events["member"].astype(np.int64) * (GROUPS - 1) + (code & 63)
        size = places.begin[leaf + 1] - places.begin[leaf]
        begin = np.append(0, np.cumsum(size))
        n = int(begin[-1])
        out = Path(begin, np.empty(n, np.int32), np.empty(n, np.int8), np.empty(n, np.float32))
        row = self.row.take(code >> 12).astype(np.int64) * (CLASSES - 1)
        shift, odds = places.begin[leaf] - begin[:-1], self.odds.reshape(-1)
        for a in range(0, len(events), CHUNK):
            some = slice(a, a + CHUNK)
            here = slice(begin[a], begin[min(a + CHUNK, len(events))])
            at = np.arange(here.start, here.stop)
            at += np.repeat(shift[some], size[some])
            out.slot[here], out.side[here], logit = self.slot.take(at), places.side.take(at), self.start.take(at)
            choice = self.between.take(at)
            between = np.flatnonzero(choice >= 0)
            logit[between] = odds.take(np.repeat(row[some], size[some]).take(between) + choice.take(between))
            out.logit[here] = logit
        return out


class WordModel:
    """The choices of a part: through the classes to one, and through its words."""

    def __init__(self, model: Model, ways: Ways | None = None) -> None:
        self.model = model
        self.ways = ways or Ways(model)
        self.levels = [Choices()]
        self.met = np.zeros((WORD_FEATURES, 1 << SLOT_BITS - 3), np.uint8)  # histories that were learned from, a bit each

    def learn(self, events: np.ndarray, rounds: int = WORD_ROUNDS) -> np.ndarray:
        """Fit the weights feature by feature, from the shortest to the longest; what :meth:`logs` then gives for ``events``."""
        if not len(events):
            return np.zeros(0)
        choices = self.levels[0]
        choices.deal(events["h"])
        order = choices.layouts[0].sorted(events["h"][:, 0])
        events = events[order]
        path = self.ways.path(events)
        for feature, met in enumerate(self.met):
            there = np.zeros(1 << SLOT_BITS, bool)
            there[word_slots(word_keys(events["h"], feature))] = True
            met[:] = np.packbits(there, bitorder="little")
        first, second = (events["h"][:, k] for k in range(2))
        one, two, more = choices.layouts
        turns = [Turn(one, first, path), Turn(two, second, path, two.sorted(second)), Turn(more, first, path)]
        for _ in range(rounds):
            for feature in range(WORD_FEATURES):
                choices.update(feature, word_slots(word_keys(events["h"], feature)), turns[LAID[feature]], path)
        out = np.empty(len(events))
        out[order] = _log_of(path)
        return out

    def logs(self, events: np.ndarray) -> np.ndarray:
        """The natural logarithm of each word's probability; of a word in group 0 that of the group.

        A feature whose history was not learned from has no weight.
        """
        out = np.empty(len(events))
        choices = self.levels[0]
        order = choices.layouts[0].sorted(events["h"][:, 0])
        for begin in range(0, len(events), CHUNK):
            some = order[begin : begin + CHUNK]
            now = events[some]
            path = self.ways.path(now)
            sizes = np.diff(path.begin)
            for feature, met in enumerate(self.met):
                k = word_slots(word_keys(now["h"], feature))
                layout, words = choices.layouts[LAID[feature]], now["h"][:, LAYOUTS[LAID[feature]][0]]
                at = np.repeat(layout.slots(words, k), sizes) ^ (path.slot & np.repeat(layout.mask.take(words), sizes))
                path.logit[:] += choices.of(feature).take(at) * np.repeat((met.take(k >> 3) >> (k & 7)) & layout.there.take(words), sizes)
            out[some] = _log_of(path)
        return out


def _log_of(path: Path) -> np.ndarray:
    out = np.zeros(len(path.begin) - 1)
    for a in range(0, len(out), CHUNK):
        begin = path.begin[a : a + CHUNK + 1]
        here = slice(begin[0], begin[-1])
        x = np.where(path.side[here], path.logit[here], -path.logit[here])
        out[a : a + CHUNK] = np.add.reduceat(np.minimum(x, 0) - np.log(1 + np.exp(-np.abs(x))), begin[:-1] - begin[0], dtype=float)
    return out


def part_count(tokens: int) -> int:
    return max(1, -(-tokens // EVENTS))


RARE = 1 << 16  # symbols below are frequent words by rank; above, class and hash of others
LAST = (1 + END) * RARE  # the end of a text, and what stands before its first word
HELD = 1 << 23  # set in symbols of words not to learn from


def _symbols(lexicon: Lexicon, s: Slice, class_of: np.ndarray, ranks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A number for each word of a dictionary, from which :func:`_events` has its class, its place and 16 bits of its hash."""
    at, known = lexicon.places(s)
    out = ((1 + class_of[TOP + s.affix]) * RARE + (hashes >> np.uint64(48)).astype(np.int64)).astype(np.int32)
    out[known] = ranks[at[known]]
    return out


def _by_rank(lexicon: Lexicon) -> np.ndarray:
    """The frequent words, the most frequent first."""
    return np.argsort(-lexicon.counts, kind="stable")


def _deal(model: Model):
    """For each part the tokens of some texts that fall to it: their words and the three before, and the texts they are from."""
    lexicon, class_of, tokens = model.lexicon, model.class_of, model.tokens
    parts, firsts = part_count(tokens), part_count(model.ends)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = np.empty(len(lexicon.hashes), np.int32)
        ranks[_by_rank(lexicon)] = np.arange(len(ranks))
        for s in _slices(batches):
            # The last entry of each array by word is for ends.
            word = np.append(mix(s.hash), np.uint64(0))
            symbol = np.append(_symbols(lexicon, s, class_of, ranks, word[:-1]), np.int32(LAST))
            hot = np.append(lexicon.find(s)[0] * 4 * parts > tokens, False)
            home = ((mix(word ^ mix(np.uint64(0))) >> np.uint64(20)) % np.uint64(parts)).astype(np.int32)
            n = len(s.sizes)
            text = np.repeat(np.arange(n, dtype=np.int32), s.sizes + 1)
            # Three ends stand before each text.
            at = np.arange(len(text)) + 3 * (text.astype(np.int64) + 1)
            seen = np.full(len(text) + 3 * n, len(s.hash), np.int32)
            ends = np.cumsum(s.sizes + 1) - 1
            is_word = np.ones(len(text), bool)
            is_word[ends] = False
            seen[at[is_word]] = s.seen
            part = home.take(seen.take(at - 1))
            split = hot.take(seen.take(at - 1))
            split[ends - s.sizes] = True
            some = np.flatnonzero(split)
            one, two, three = (word.take(seen.take(at[some] - lag)) for lag in (1, 2, 3))
            # First words all have one history: their texts deal them out.
            lone = s.more["k1"].to_numpy(zero_copy_only=False).view(np.uint64)[text[some]] % np.uint64(firsts)
            begins = np.zeros(len(text), bool)
            begins[ends - s.sizes] = True
            more = np.where(begins[some], mix(lone), mix(two ^ mix(three + np.uint64(1))))
            part[some] = (mix(one ^ more) >> np.uint64(20)) % np.uint64(parts)
            order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
            part, at, text = part[order], at[order], text[order]
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.empty(0, np.int64)
            cuts = list(zip(first, np.append(first, len(part))[1:], strict=True))
            learn = s.learned()
            planes = np.empty((16, len(part)), np.uint8)
            for lag in range(4):
                x = symbol.take(seen.take(at - lag))
                if lag == 0:
                    x = x | np.where(learn[text], 0, HELD).astype(np.int32)
                planes[3 * lag : 3 * lag + 3] = x.view(np.uint8).reshape(-1, 4).T[:3]
            step = np.diff(text, prepend=np.int32(0))
            step[first] = text[first]
            planes[12:] = step.view(np.uint8).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[first]),
                    pa.array([s.number] * len(cuts), pa.int64()),
                    pa.array([b - a for a, b in cuts], pa.int32()),
                    pa.array([compressed(planes[:, a:b]) for a, b in cuts], pa.binary()),
                ],
                ["part", "slice", "n", "tokens"],
            )
        trim()

    return deal


def _dealt(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Symbols (of the word, and of the three before it) and texts of the tokens of a part."""
    symbols, texts = [], []
    for n, tokens in zip(table.column("n").to_pylist(), table.column("tokens"), strict=True):
        planes = np.frombuffer(CODEC.decompress(tokens.as_buffer(), 16 * n), np.uint8).reshape(16, n)
        x = np.zeros((n, 16), np.uint8)
        for lag in range(4):
            x[:, 4 * lag : 4 * lag + 3] = planes[3 * lag : 3 * lag + 3].T
        symbols.append(x.view("<i4"))
        texts.append(np.cumsum(np.ascontiguousarray(planes[12:].T).view("<i4").reshape(-1)))
    return np.concatenate(symbols), np.concatenate(texts)


def _events(model: Model, symbols: np.ndarray) -> np.ndarray:
    places, order = model.words, _by_rank(model.lexicon)
    by_class = np.append(model.class_of[model.lexicon.types[order]], 0).astype(np.uint32)
    by_hash = np.append(mix(model.lexicon.hashes[order]) >> np.uint64(48), 0).astype(np.uint16)
    out, code = np.empty(len(symbols), EVENT), np.zeros(len(symbols), np.uint32)
    for lag in (3, 2, 1, 0):
        x = symbols[:, lag] & (HELD - 1)
        rank = np.where(x < RARE, x, len(order))  # past the frequent words
        kind = np.where(x < RARE, by_class.take(rank), ((x >> 16) - 1).astype(np.uint32))
        if lag:
            out["h"][:, lag - 1] = np.where(x < RARE, by_hash.take(rank), x.astype(np.uint16))
            code = code * np.uint32(CLASSES) + kind
        else:
            out["code"] = code << 12 | kind << 6 | np.append(places.group[order], 0).astype(np.uint32).take(rank)
            out["member"] = np.append(places.member[order], 0).astype(np.uint16).take(rank)
    return out


def word_scores(coded: DataFrame, model: Model, rounds: int = WORD_ROUNDS) -> DataFrame:
    """``slice, texts, scores``: sums of the tokens of some parts, by text.

    Each part learns from the tokens of texts to learn from, then scores all of its tokens.
    """
    sent = coded.sparkSession.sparkContext.broadcast(model)
    ways: list[Ways] = []  # those of a task

    def fit(table: pa.Table) -> pa.Table:
        model = sent.value
        if not ways:
            ways.append(Ways(model))
        trim()
        symbols, texts = _dealt(table)
        learn = symbols[:, 0] < HELD
        events = _events(model, symbols)
        del symbols
        trim()
        words = WordModel(model, ways[0])
        logs = np.empty(len(events))
        logs[learn] = words.learn(events[learn], rounds)
        logs[~learn] = words.logs(events[~learn])
        del words, events
        trim()
        ends = np.cumsum(table.column("n").to_numpy())
        numbers, sums = [], []
        for a, b in zip(np.append(0, ends), ends, strict=False):
            begin = np.flatnonzero(np.append(True, texts[a + 1 : b] != texts[a : b - 1]))
            numbers.append(pack(np.diff(texts[a:b][begin], prepend=0).astype(np.int32)))
            sums.append((np.add.reduceat(logs[a:b], begin) / np.log(10)).astype(np.float32).tobytes())
        return pa.table({"slice": table.column("slice"), "texts": pa.array(numbers, pa.binary()), "scores": pa.array(sums, pa.binary())})

    dealt = coded.select(*CODED, "k1").mapInArrow(_deal(model), "part int, slice bigint, n int, tokens binary")
    return dealt.groupBy("part").applyInArrow(fit, "slice bigint, texts binary, scores binary")


def _walk(model: Model):
    """For each text what it is made of: words with counts, those among them without a softmax, and its score so far."""
    least, ends = model.lexicon.counts.min(initial=2**62), model.ends
    class_of, share_of = model.class_of, model.words.rare

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _slices(batches):
            found = sorted(s.more["counts"].to_pylist(), key=lambda x: x["bucket"])
            count = np.concatenate([np.empty(0, np.int64), *(unpack(x["n"], "<i8") for x in found)])
            n = len(s.sizes)
            row = np.repeat(np.arange(n), s.sizes)
            sums = np.bincount(row, np.log10(count + 1).take(s.seen), n) + np.log10(ends + 1)
            known = np.bincount(row, (count > 0).take(s.seen), n).astype(np.int64) + (ends > 0)
            # Softmaxes give frequent words and ends as a whole; of the others the group, in which they have their shares.
            frequent = np.log10(count + 1)
            share = np.where(count >= least, -frequent, -share_of[class_of[TOP + s.affix]])
            scored = np.bincount(row, share.take(s.seen), n) - np.log10(ends + 1)
            words = np.zeros(n)
            for x in s.more["scores"].to_pylist():
                words[np.cumsum(unpack(x["texts"], "<i4"))] += np.frombuffer(x["scores"], np.float32)
            yield pa.RecordBatch.from_arrays(
                [*(s.more[x] for x in ("doc_id", "k1", "k2", "learn")), *map(pa.array, (s.sizes + 1, known, sums, scored, words))],
                ["doc_id", "k1", "k2", "learn", "n_tokens", "n_known", "sums", "scored", "word_score"],
            )

    return walk


def walk_texts(coded: DataFrame, model: Model, counted: DataFrame, by_words: DataFrame) -> DataFrame:
    """A row for each text of ``coded``, from the counts of its words and what parts gave them."""
    scores = by_words.groupBy("slice").agg(F.collect_list(F.struct("texts", "scores")).alias("scores"))
    counts = counted.filter(F.col("slice").isNotNull())
    counts = counts.groupBy("slice").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
    texts = coded.drop("words").join(scores, "slice").join(counts, "slice", "left")
    kind = coded.schema["doc_id"].dataType.elementType.simpleString()
    return texts.mapInArrow(
        _walk(model),
        f"doc_id {kind}, k1 bigint, k2 bigint, learn boolean, n_tokens bigint, n_known bigint, sums double, scored double, "
        "word_score double",
    )


def score_texts(walked: DataFrame, model: Model) -> DataFrame:
    """``doc_id, learn, n_tokens, n_known, base_score, score`` per row of ``walked``.

    A text is known by two hashes, so its copies share what the softmaxes give them.
    """
    copies = walked.groupBy("k1", "k2").agg(F.avg("word_score").alias("word_score"))
    rows = walked.drop("word_score").join(copies, ["k1", "k2"])
    base = F.col("sums") - F.col("n_tokens") * F.log10(F.lit(model.tokens + model.vocabulary + 1).cast("double"))
    score = F.col("sums") + F.col("scored") + F.col("word_score")
    return rows.select("doc_id", "learn", "n_tokens", "n_known", base.alias("base_score"), score.alias("score"))


def language_scores(docs: DataFrame, folds: int = 7, held_out: int = 2, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``.

    Learns from all rows but those of one fold of ids. A null or empty text is
    its end alone. Repeated rows are counted as often as they occur and scored
    alike; rows without id are in no fold, so they are learned from. Without
    any training text the base is 0 a token, and the model is uniform over
    classes.
    """
    ship(docs.sparkSession)
    out = F.coalesce(fold_of(F.col("doc_id"), folds) == held_out, F.lit(False))
    with finished_shuffles_go(docs.sparkSession):
        coded = materialize(code_texts(docs, ~out), "lm-texts")
        counted = materialize(count_words(coded), "lm-counts")
        model = train(coded, words_counted(counted), rounds)
        by_words = materialize(word_scores(coded, model), "lm-words")
        walked = materialize(walk_texts(coded, model, counted, by_words), "lm-scores")
    for table in (coded, counted, by_words):
        drop_table(table)
    release(docs.sparkSession)
    scored = score_texts(walked, model)
    return scored.select(
        "doc_id",
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
