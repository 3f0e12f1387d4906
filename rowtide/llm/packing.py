"""Packing of tokenised documents by a grouping genetic algorithm.

Documents are tokenised, common words by rank and others with a bounded memory
of known words, cut only where they exceed a sequence, and dealt at random into shards of a few
thousand pieces. Several islands evolve packings of the same shard: crossover
injects whole well-filled bins of one parent into another, takes out the bins
that held the same pieces, and puts the displaced pieces back by best fit;
mutation empties some of the worst bins. Before best fit, displaced pieces
change places with smaller ones wherever that fills a bin better. Between epochs each island's best
packing migrates to the next island of its shard through a join. The best of a
shard's islands places its pieces.

The number of shards grows with the number of pieces, so each task's work is
bounded. The emptiest sequence of each shard is unpacked and packed with those
of the others in a second, far smaller round of shards, and so on until one
shard is left.
"""

from __future__ import annotations

import json
import random
import re
import string
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rowtide.llm.batches import text_slices
from rowtide.llm.common import materialize
from rowtide.session import ship

CAPACITY = 2048
SEPARATOR = 0
SHARD_PIECES = 4_000
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
OFFSPRING = 8
CACHE = 100_000
TOGETHER = 128
CLOSE, ENDED = "</w>", b"\0"  # the end of a word in a vocabulary and in the bytes of a token here
SLICE_BYTES = 1_000_000
# Letters that have one lower-case letter each, whatever stands beside them: ASCII, and U+00C0 to U+017F but one.
ASCII = re.compile(rb"[A-Za-z]+")
LATIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|\xc5[\x80-\xbf])+")
MARKS = string.punctuation.encode()
ODD, LETTER, MARK, SPACE = range(4)
OTHER_WORD, TEXT_END = b"\1", b"\2"  # stand for a word to look up, and for the end of a text
PLAIN = bytes(ord(chr(b).lower()) if b < 128 else b for b in range(256)).translate(
    bytes(0 if b in b" \t\n\v\f\r" else b for b in range(256))
)
KIND = np.full(256, ODD, np.uint8)
KIND[[*string.ascii_letters.encode(), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = LETTER
KIND[[*MARKS]] = MARK
KIND[0] = SPACE


def _byte_of_mark() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _ranks(path: str) -> dict[bytes, int]:
    """Ids by bytes, with ``ENDED`` after those that end a word, of a byte-pair vocabulary numbered in the order
    of its merges: bytes, bytes that end a word, merged tokens. Empty for any other vocabulary."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    if model.get("type") != "BPE" or model.get("end_of_word_suffix") != CLOSE or model.get("dropout"):
        return {}
    marks = _byte_of_mark()
    ids = {t: i for t, i in model["vocab"].items() if set(t.removesuffix(CLOSE)) <= marks.keys()}
    single = [*marks, *(m + CLOSE for m in marks)]
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if set(ids) != {*single, *merged} or sorted(map(ids.get, single[:256])) != [*range(256)]:
        return {}
    if sorted(map(ids.get, single[256:])) != [*range(256, 512)] or list(map(ids.get, merged)) != [*range(512, len(ids))]:
        return {}
    return {bytes(marks[c] for c in t.removesuffix(CLOSE)) + ENDED * t.endswith(CLOSE): i for t, i in ids.items()}


@cache
def never_made(path: str) -> frozenset[int] | None:
    """Ids of merged tokens that no word gives; none if the words of this vocabulary cannot be merged by rank.

    Merging by rank joins any two neighbours whose bytes are a token, the
    tokenizer only the listed pair. The outcome is the same if each token's own
    bytes give that token, since whatever is merged inside it before is then the
    listed pair, in a longer word too. Tokens that do not give themselves are
    never made and are left out.
    """
    from tokenizers.models import BPE

    ids = _ranks(path)
    if not ids:
        return None
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    inside, ending = (BPE(vocab=model["vocab"], merges=pairs, **more) for more in ({}, {"end_of_word_suffix": CLOSE}))
    out = set()
    for token, i in model["vocab"].items():
        last = token.endswith(CLOSE)
        if 512 <= i < len(ids) and [t.id for t in (ending if last else inside).tokenize(token.removesuffix(CLOSE))] != [i]:
            out.add(i)
    return frozenset(out)


class WordIds(dict):
    """Token ids of a word as little-endian bytes.

    The tokenizer drops white space and reads the words between it one by one,
    in lower case, so the ids of a text are those of its words in order. Only
    marks that are tokens of their own must keep their case. Letters and the
    punctuation after them are separate tokens. Words of Latin letters are merged
    by rank, all of a slice at once; others are looked up one by one, and the
    ``CACHE`` read last and as many from before them are remembered.
    """

    def __init__(self, path: str, without: frozenset[int] | None = None) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.before: dict[bytes, bytes] = {}
        self.ranked, self.letters = None, ASCII
        if without is not None:
            ranks = {t: i for t, i in _ranks(path).items() if i not in without}
            self.closes = np.zeros(1 + max(ranks.values()), bool)
            self.closes[[i for t, i in ranks.items() if len(t) > 1 and t.endswith(ENDED)]] = True
            encoding = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
            self.ranked = encoding.encode_to_numpy
            self.other, self.end = ranks[OTHER_WORD + ENDED], ranks[TEXT_END + ENDED]
            every = [c.encode() for c in map(chr, range(0xC0, 0x180)) if LATIN.fullmatch(c.encode())]
            self.merge(every)
            merged = [self[c] for c in every]
            self.ask(every)
            self.letters = LATIN if merged == [self[c] for c in every] else ASCII

    def forget(self) -> None:
        self.clear()
        self.before = {}

    def learn(self, words: list[bytes]) -> None:
        whole, ended = [], []
        is_word = self.letters.fullmatch
        for w in words:
            core = w.rstrip(MARKS)
            if core != w and is_word(core):
                ended.append((w, core, w[len(core) :]))
            else:
                whole.append(w)
        for part in {p for _, *parts in ended for p in parts}.difference(self):
            ids = self.before.get(part)
            if ids is None:
                whole.append(part)
            else:
                self[part] = ids
        self.read(list(dict.fromkeys(whole)))
        for w, core, end in ended:
            self[w] = self[core] + self[end]

    def read(self, words: list[bytes]) -> None:
        """Merge words of Latin letters by rank; ask the tokenizer for others. Some hundred go in one text."""
        plain, others = [], words
        if self.ranked:
            is_word = self.letters.fullmatch
            plain = [w for w in words if is_word(w)]
            others = [w for w in words if not is_word(w)]
        for begin in range(0, len(plain), TOGETHER):
            self.merge(plain[begin : begin + TOGETHER])
        for begin in range(0, len(others), TOGETHER):
            self.ask(others[begin : begin + TOGETHER])

    def merge(self, words: list[bytes]) -> None:
        ids = self.ranked((ENDED.join(words) + ENDED).decode("utf-8").lower())
        self.keep(words, ids, 4 * (np.flatnonzero(self.closes[ids]) + 1))

    def ask(self, words: list[bytes]) -> None:
        shown = [w.decode("utf-8") for w in words]
        found = self.tokenizer.encode(" ".join(shown), add_special_tokens=False)
        ends = np.cumsum([len(w) + 1 for w in shown])
        whose = np.searchsorted(ends, np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids)), side="right")
        self.keep(words, np.array(found.ids, "<u4"), 4 * np.cumsum(np.bincount(whose, minlength=len(words))))

    def keep(self, words: list[bytes], ids: np.ndarray, cuts: np.ndarray) -> None:
        whole, ends = ids.tobytes(), cuts.tolist()
        for w, a, z in zip(words, [0, *ends[:-1]], ends, strict=True):
            self[w] = whole[a:z]

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """The ids of whole texts."""
        if self.letters is not LATIN:
            return self.by_word(texts)
        cased = {k: text for k, text in enumerate(texts) if b"<|" in text or b"\0" in text}
        out = self.by_rank([b"" if k in cased else text for k, text in enumerate(texts)])
        for k, ids in zip(cased, self.by_word(list(cased.values())), strict=True):
            out[k] = ids
        return out

    def by_word(self, texts: list[bytes]) -> list[bytes]:
        split = [(text if b"<|" in text else text.lower()).split() for text in texts]
        self.know(*split)
        return [b"".join(map(self.__getitem__, words)) for words in split]

    def know(self, *split: list[bytes]) -> None:
        if len(self) > CACHE:
            self.before = dict(self)
            self.clear()
        new = set().union(*split).difference(self)
        known = {w: ids for w in new if (ids := self.before.get(w)) is not None}
        self.update(known)
        self.learn(list(new.difference(known)))

    def by_rank(self, texts: list[bytes]) -> list[bytes]:
        """Merge all words of Latin letters and the punctuation after them at once, look up the others.

        A zero byte ends each piece; a word of another kind is one mark in the
        text that is merged, and its ids take the place of that mark's.
        """
        end = ENDED + TEXT_END + ENDED
        whole = end.join(text.translate(PLAIN) for text in texts) + end
        shown = np.frombuffer(whole, np.uint8)
        kind = KIND[shown]
        stops = np.flatnonzero(shown == 0)
        # Of the letters two are signs and one has no single lower-case letter; marks stand at the end of a word.
        pair = shown[:-1].astype(np.uint16) << 8 | shown[1:]
        odd = kind == ODD
        odd[:-1] |= (pair == 0xC397) | (pair == 0xC3B7) | (pair == 0xC4B0) | ((kind[:-1] == MARK) & (kind[1:] == LETTER))
        at = np.unique(np.searchsorted(stops, np.flatnonzero(odd)))
        begin, stop = np.append(0, stops[:-1] + 1)[at], stops[at]
        ends = (stop - begin == 1) & (shown[begin] == TEXT_END[0])
        ends &= np.isin(stop, np.cumsum([len(text) + len(end) for text in texts]) - 1)
        begin, stop = begin[~ends], stop[~ends]
        others = [whole[a:z] for a, z in zip(begin.tolist(), stop.tolist(), strict=True)]
        changed = shown.copy()
        changed[begin] = OTHER_WORD[0]
        inside = np.zeros(len(shown) + 1, np.int8)
        inside[begin + 1] += 1
        inside[stop] -= 1
        gone = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        split = np.zeros(len(shown), bool)
        split[1:] = (kind[:-1] == LETTER) & (kind[1:] == MARK) & ~gone[1:]
        split[begin + 1] = False
        changed = np.insert(changed[~gone], np.flatnonzero(split[~gone]), 0)
        ids = self.ranked(changed.tobytes().decode("utf-8").lower())
        here = ids == self.other
        self.know(others)
        found = list(map(self.__getitem__, others))
        size = np.ones(len(ids), np.int64)
        size[here] = [len(x) // 4 for x in found]
        taken = np.repeat(here, size)
        out = np.empty(len(taken), "<u4")
        out[~taken] = ids[~here]
        out[taken] = np.frombuffer(b"".join(found), "<u4")
        last = (np.cumsum(size) - 1)[ids == self.end]
        parts = out.tobytes()
        return [parts[4 * a : 4 * z] for a, z in zip([0, *(last[:-1] + 1).tolist()], last.tolist(), strict=True)]

_KNOWN: dict[str, WordIds] = {}  # the tokenizer stays with the Python worker for the next task, its words do not


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """``item, doc_id, piece, start, length, ids_crc32`` per piece, and ``ids`` if asked for.

    ``tokenizer`` is the path of a tokenizers file, the same on all machines. A
    document is its token ids and one separator; a null or empty text is the
    separator alone. ``item`` numbers the pieces; write the result before
    reading it twice, since another run may number them otherwise.
    """
    ship(docs.sparkSession)
    end = np.array([SEPARATOR], "<u4").tobytes()
    without = never_made(tokenizer)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _KNOWN:
            _KNOWN[tokenizer] = WordIds(tokenizer, without)
        known = _KNOWN[tokenizer]
        item = TaskContext.get().partitionId() << 36
        for batch in text_slices(batches, SLICE_BYTES):
            rows, pieces, starts, parts = [], [], [], []
            for row, whole in enumerate(known.texts(batch.column("text").to_pylist())):
                whole += end
                for piece, at in enumerate(range(0, len(whole), 4 * capacity)):
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at // 4)
                    parts.append(whole[at : at + 4 * capacity])
            columns = [
                pa.array(np.arange(item, item + len(rows))),
                batch.column("doc_id").take(pa.array(rows, pa.int64())),
                pa.array(pieces, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array([len(p) // 4 for p in parts], pa.int64()),
                pa.array([zlib.crc32(p) for p in parts], pa.int64()),
            ]
            names = ["item", "doc_id", "piece", "start", "length", "ids_crc32"]
            if ids:
                columns.append(pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in parts], pa.list_(pa.int32())))
                names.append("ids")
            item += len(rows)
            yield pa.RecordBatch.from_arrays(columns, names)
        known.forget()

    kind = docs.schema["doc_id"].dataType.simpleString()
    more = ", ids array<int>" if ids else ""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(
        cut, f"item bigint, doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint{more}"
    )


class Packing:
    """Bins of items; free space is looked up in a sorted list."""

    def __init__(self, sizes: list[int], capacity: int) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.bins: dict[int, list[int]] = {}
        self.room: dict[int, int] = {}
        self.free: list[tuple[int, int]] = []
        self.next = 0

    def open(self, items: list[int]) -> None:
        self.bins[self.next] = list(items)
        self.room[self.next] = self.capacity - sum(self.sizes[i] for i in items)
        insort(self.free, (self.room[self.next], self.next))
        self.next += 1

    def close(self, number: int) -> list[int]:
        del self.free[bisect_left(self.free, (self.room.pop(number), number))]
        return self.bins.pop(number)

    def put(self, items: list[int]) -> None:
        """Best fit: into the fullest bin with room, else into a new one."""
        for i in items:
            size = self.sizes[i]
            at = bisect_left(self.free, (size, -1))
            if at == len(self.free):
                self.open([i])
                continue
            room, number = self.free.pop(at)
            self.bins[number].append(i)
            self.room[number] = room - size
            insort(self.free, (room - size, number))

    def copy(self) -> Packing:
        out = Packing(self.sizes, self.capacity)
        out.bins = {n: list(b) for n, b in self.bins.items()}
        out.room, out.free, out.next = dict(self.room), list(self.free), self.next
        return out

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first; of as many, rather full and empty ones than all alike."""
        return -len(self.bins), sum((self.capacity - r) ** 2 for r in self.room.values())

    def labels(self) -> list[int]:
        out = [0] * len(self.sizes)
        for label, items in enumerate(self.bins.values()):
            for i in items:
                out[i] = label
        return out


def from_labels(sizes: list[int], capacity: int, labels: list[int]) -> Packing:
    groups: dict[int, list[int]] = {}
    for i, label in enumerate(labels):
        groups.setdefault(label, []).append(i)
    out = Packing(sizes, capacity)
    for items in groups.values():
        out.open(items)
    return out


def first_packing(sizes: list[int], capacity: int, noise: float, dice: random.Random) -> Packing:
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i] * (1 + noise * dice.random()))
    out = Packing(sizes, capacity)
    out.put(order)
    return out


def replace(p: Packing, loose: list[int]) -> list[int]:
    """Exchange pieces of bins for larger loose ones, or for two of them, where these fill the bin better.

    The pieces that come out are smaller, so they are easier to place. Returns
    the loose pieces after it, largest first.
    """
    sizes = p.sizes
    order = sorted((sizes[i], i) for i in loose)
    for room, number in [*p.free]:
        if not room or not order:
            continue
        items = p.bins[number]
        best = (0, None, ())
        for i in items:
            space = sizes[i] + room
            at = bisect_left(order, (space + 1, -1)) - 1
            if at >= 0 and order[at][0] - sizes[i] > best[0]:
                best = (order[at][0] - sizes[i], i, (order[at],))
            low, high = 0, min(at, len(order) - 1)
            while best[0] < room and low < high:
                both = order[low][0] + order[high][0]
                if both > space:
                    high -= 1
                    continue
                if both - sizes[i] > best[0]:
                    best = (both - sizes[i], i, (order[low], order[high]))
                low += 1
            if best[0] == room:
                break
        gain, out, into = best
        if out is None:
            continue
        p.close(number)
        items.remove(out)
        for piece in into:
            order.remove(piece)
        insort(order, (sizes[out], out))
        p.open([*items, *(i for _, i in into)])
    return [i for _, i in reversed(order)]


def crossover(a: Packing, b: Packing, dice: random.Random) -> Packing:
    """``a`` with some of the fullest bins of ``b`` injected whole."""
    full = [n for room, n in b.free[: max(1, len(b.free) // 2)]]
    inject = [b.bins[n] for n in dice.sample(full, max(1, len(full) // 3))]
    taken = {i for items in inject for i in items}
    out = a.copy()
    displaced = [
        i
        for n in [n for n, items in a.bins.items() if not taken.isdisjoint(items)]
        for i in out.close(n)
        if i not in taken
    ]
    for items in inject:
        out.open(items)
    out.put(replace(out, displaced))
    return out


def mutate(p: Packing, dice: random.Random) -> None:
    """Empty some of the bins with the most room and put their pieces back."""
    worst = [n for _, n in p.free[-max(2, len(p.free) // 20) :]]
    some = dice.sample(worst, max(1, len(worst) // 2)) + dice.sample([*p.bins], min(3, len(p.bins)))
    loose = [i for n in set(some) for i in p.close(n)]
    p.put(replace(p, loose))


def evolve(sizes: list[int], capacity: int, elites: list[list[int]], seed: int) -> tuple[list[int], list[float]]:
    """The best packing found, as a bin by item, and its fitness. Starts from ``elites`` and fresh packings."""
    dice = random.Random(seed)
    population = [from_labels(sizes, capacity, e) for e in elites]
    while len(population) < POPULATION:
        noise = 0.0 if not population else 0.3 * dice.random()
        population.append(first_packing(sizes, capacity, noise, dice))
    need = -(-sum(sizes) // capacity)
    scored = sorted(((p.fitness(), k, p) for k, p in enumerate(population)), reverse=True, key=lambda x: x[:2])
    for k in range(OFFSPRING):
        if -scored[0][0][0] <= need:
            break  # no packing has fewer bins
        a, b = dice.sample(scored, 2)
        child = crossover(a[2], b[2], dice)
        mutate(child, dice)
        scored = sorted([*scored, (child.fitness(), len(population) + k, child)], reverse=True, key=lambda x: x[:2])[:POPULATION]
    (bins, square), _, best = scored[0]
    return best.labels(), [float(bins), float(square)]


def _epoch(capacity: int, number: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for shard, island, items, sizes, elite, guest in b.itertuples(index=False, name=None):
                elites = [list(e) for e in (elite, guest) if e is not None and len(e)]
                seed = (int(shard) * 1009 + int(island)) * 31 + number
                labels, fitness = evolve([int(s) for s in sizes], capacity, elites, seed)
                out.append((shard, island, items, sizes, labels, fitness))
            yield pd.DataFrame(out, columns=["shard", "island", "items", "sizes", "elite", "fitness"])

    return run


_STATE = "shard bigint, island int, items array<bigint>, sizes array<int>, elite array<int>, fitness array<double>"


def _pack_shards(pieces: DataFrame, capacity: int, shards: int, first: int, label: str) -> DataFrame:
    """``shard, bin, in``: the sequences of ``pieces`` (item, size), dealt to ``shards`` numbered from ``first``."""
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(shards)) + first)
    # A shard's pieces are few whatever the input: their number is set, not found.
    grouped = dealt.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("item", "size"))).alias("s"))
    state = grouped.select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        F.col("s.item").alias("items"),
        F.col("s.size").alias("sizes"),
        F.array().cast("array<int>").alias("elite"),
        F.array().cast("array<int>").alias("guest"),
    )
    for number in range(EPOCHS):
        tasks = max(1, min(shards * ISLANDS, 10_000))
        spread = state.repartition(tasks, "shard", "island")
        now = materialize(spread.mapInPandas(_epoch(capacity, number), _STATE), f"{label}-{number}")
        guests = now.select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("elite").alias("guest"))
        state = now.drop("fitness").join(guests, ["shard", "island"])
        state = state.select("shard", "island", "items", "sizes", "elite", "guest")
    best = now.groupBy("shard").agg(
        F.max_by(F.struct("items", "sizes", "elite"), F.struct("fitness", -F.col("island"))).alias("b")
    )
    placed = best.select(
        "shard",
        F.inline(F.arrays_zip(F.col("b.items").alias("item"), F.col("b.sizes").alias("size"), F.col("b.elite").alias("bin"))),
    )
    return placed.groupBy("shard", "bin").agg(F.sort_array(F.collect_list(F.struct("item", "size"))).alias("in"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``item, sequence_id, offset`` for written ``pieces`` (item, length up to ``capacity``).

    The emptiest sequence of each shard is unpacked, and its pieces are packed
    with those of the other shards, until one shard is left. Empty input packs
    into nothing. The outcome depends on the items and lengths only, not on the
    order of rows.
    """
    ship(pieces.sparkSession)
    left = pieces.select("item", F.col("length").cast("int").alias("size"))
    there, first, done = left.count(), 0, []
    while True:
        shards = 1 + there // SHARD_PIECES
        bins = _pack_shards(left, capacity, shards, first, f"packing-{first}")
        if shards == 1:
            done.append(bins)
            break
        bins = materialize(bins, f"packing-bins-{first}")
        fill = F.aggregate("in", F.lit(0).cast("bigint"), lambda a, x: a + x["size"])
        emptiest = bins.groupBy("shard").agg(F.min_by("bin", F.struct(fill, "bin")).alias("bin"))
        emptiest = materialize(emptiest, f"packing-rims-{first}")
        done.append(bins.join(emptiest, ["shard", "bin"], "left_anti"))
        left = bins.join(emptiest, ["shard", "bin"], "left_semi").select(F.inline("in"))
        left = materialize(left, f"packing-left-{first}")
        before, there, first = there, left.count(), first + shards
        if there == before:  # a sequence a shard: nothing to gain
            done[-1] = bins
            break
    return reduce(DataFrame.unionByName, done).select(
        (F.col("shard") * (1 << 20) + F.col("bin")).alias("sequence_id"),
        F.posexplode("in").alias("k", "s"),
        "in",
    ).select(
        F.col("s.item").alias("item"),
        "sequence_id",
        F.aggregate(F.slice("in", F.lit(1), F.col("k")), F.lit(0).cast("bigint"), lambda a, x: a + x["size"]).alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Pieces of all ``docs`` with ``sequence_id`` and ``offset``; with ``ids`` also their token ids.

    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. Every row
    is packed, repeated ones too; rows without id keep a null id.
    """
    pieces = materialize(token_pieces(docs, tokenizer, capacity, ids), "token-pieces")
    return pieces.join(pack(pieces, capacity), "item").drop("item")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the token ids of each sequence, from :func:`pack_documents` with ids."""
    together = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return together.select("sequence_id", F.flatten("p.ids").alias("ids"))
