"""Ranked lexical search the other way round.

The items are the index: a broadcast inverted index maps each term of an item to
the items that hold it, and the documents stream past it. A first pass over the
texts keeps, per document, how often it holds each indexed term; corpus counts
come from that table; a second pass over it scores and keeps the best few
documents of each item in bounded heaps, one set per task, which are merged.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rowtide.llm.batches import text_slices
from rowtide.llm.common import drop_table, materialize
from rowtide.session import ship

TOP = 10
INDEX_BYTES = 16_000_000
PIECE_BYTES = 1_000_000
PAIRS = 500_000
CELLS = 4_000_000

# Terms are runs of ASCII letters and digits and of bytes beyond ASCII; all others become spaces.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded part of it at a time."""
    plain = text.translate(_TABLE)
    start = 0
    while start < len(plain):
        cut = plain.find(b" ", start + PIECE_BYTES) if len(plain) - start > PIECE_BYTES else -1
        end = len(plain) if cut < 0 else cut
        yield plain[start:end].split()
        start = end


def term_counts(batches: Iterable[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """``doc_id, n, terms, tfs``: all terms of each document counted, and the indexed ones by number."""
    known = vocabulary.get
    for batch in text_slices(batches):
        sizes, lengths, ids, tfs = [], [0], [], []
        for text in batch.column("text"):
            n, found = 0, Counter()
            for words in pieces(text.as_py() or b""):
                n += len(words)
                found.update(map(known, words))
            del found[None]
            sizes.append(n)
            ids.extend(found.keys())
            tfs.extend(found.values())
            lengths.append(len(ids))
        offsets = pa.array(lengths, pa.int32())
        columns = {
            "doc_id": batch.column("doc_id"),
            "n": pa.array(sizes, pa.int64()),
            "terms": pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
            "tfs": pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64())),
        }
        yield pa.RecordBatch.from_pydict(columns)


class Heaps:
    """The ``top`` best ``(score, doc_id)`` of every item, as two arrays; empty places score 0."""

    def __init__(self, items: int, top: int):
        self.score = np.zeros((items, top), np.int64)
        self.doc = np.full((items, top), np.iinfo(np.int64).max)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        least, last = self.score[item, -1], self.doc[item, -1]
        better = (score > least) | ((score == least) & (doc < last))
        item, score, doc = item[better], score[better], doc[better]
        if not len(item):
            return
        items, top = np.unique(item), self.score.shape[1]
        item = np.concatenate([item, np.repeat(items, top)])
        score = np.concatenate([score, self.score[items].ravel()])
        doc = np.concatenate([doc, self.doc[items].ravel()])
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = place < top
        self.score[item[kept], place[kept]] = score[kept]
        self.doc[item[kept], place[kept]] = doc[kept]


def best_documents(
    batches: Iterable[pa.RecordBatch], starts: np.ndarray, items: np.ndarray, weight: np.ndarray, n_items: int, top: int
) -> Iterator[pa.RecordBatch]:
    """``item, doc_id, score``: the heaps of one task, when its documents have passed.

    ``items[starts[t]:starts[t + 1]]`` hold term ``t``, which weighs ``weight[t]``.
    Documents are scored in runs of bounded term-item pairs and document-item cells.
    """
    heaps = Heaps(n_items, top)
    held = np.diff(starts)
    for batch in batches:
        terms, tfs = batch.column("terms"), batch.column("tfs")
        ends = terms.offsets.to_numpy().astype(np.int64)
        first, ends = int(ends[0]), ends - ends[0]
        t = terms.values.to_numpy()[first : first + ends[-1]]
        tf = tfs.values.to_numpy()[int(tfs.offsets[0].as_py()) :][: ends[-1]]
        row = np.repeat(np.arange(len(terms)), np.diff(ends))
        doc = batch.column("doc_id").to_numpy()
        m = batch.column("m").to_numpy()[row]
        part = weight[t] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        pairs = np.concatenate([[0], np.cumsum(held[t])])[ends]
        begin, most = 0, max(1, CELLS // n_items)
        while begin < len(terms):
            end = int(np.searchsorted(pairs, pairs[begin] + PAIRS, side="right")) - 1
            end = min(max(end, begin + 1), begin + most, len(terms))
            a, b = ends[begin], ends[end]
            reps = held[t[a:b]]
            within = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
            item = items[np.repeat(starts[t[a:b]], reps) + within]
            cells = np.zeros((end - begin) * n_items, np.int64)
            np.add.at(cells, np.repeat(row[a:b] - begin, reps) * n_items + item, np.repeat(part[a:b], reps))
            hit = np.flatnonzero(cells)
            heaps.add(hit % n_items, cells[hit], doc[begin + hit // n_items])
            begin = end
    item, place = np.nonzero(heaps.score)
    yield pa.RecordBatch.from_pydict(
        {"item": pa.array(item, pa.int64()), "doc_id": heaps.doc[item, place], "score": heaps.score[item, place]}
    )


def _search_block(docs: DataFrame, block: list[tuple[int, bytes]], top: int) -> DataFrame:
    """``item, doc_id, score`` of the best documents for items given by number, from each task's heaps."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    postings: set[tuple[int, int]] = set()
    numbers = sorted({number for number, _ in block})
    local = {number: i for i, number in enumerate(numbers)}
    for number, text in block:
        for words in pieces(text):
            postings.update((vocabulary.setdefault(w, len(vocabulary)), local[number]) for w in words)
    sent = spark.sparkContext.broadcast(vocabulary)
    counted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        lambda batches: term_counts(batches, sent.value), "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"
    )
    counted = materialize(counted, "search-terms")
    n, total = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # bounded by the index
    weight = np.array(
        [math.floor(1000 * math.log((2 * n + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(vocabulary))], np.int64
    )
    ordered = np.array(sorted(postings), np.int64).reshape(-1, 2)
    starts = np.searchsorted(ordered[:, 0], np.arange(len(vocabulary) + 1))
    index = spark.sparkContext.broadcast((starts, ordered[:, 1], weight, np.array(numbers)))

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, items, weight, numbers = index.value
        for out in best_documents(batches, starts, items, weight, len(numbers), top):
            yield out.set_column(0, "item", pa.array(numbers[out.column("item").to_numpy()]))

    length = F.expr(f"10 + CAST(CAST(90 * n AS DECIMAL(20, 0)) * {n} DIV {max(total, 1)} AS BIGINT)")
    found = counted.filter(F.col("doc_id").isNotNull() & (F.size("terms") > 0)).select(
        "doc_id", length.alias("m"), "terms", "tfs"
    )
    best = materialize(
        found.mapInArrow(scored, "item bigint, doc_id bigint, score bigint"), "search-heaps"
    )
    drop_table(counted)
    return best


def search_documents(docs: DataFrame, items: DataFrame, top: int = TOP, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` highest-scoring documents of every item.

    Null and empty texts have no terms: such documents count nowhere, such items
    find nothing. Rows of ``items`` with one id are one item with the terms of
    all of them; items without id are passed over. Every row of ``docs`` is a
    document, rows of one id too; one without id counts in the statistics but
    cannot be named, so it is not listed. Equal scores rank by id. Very long
    texts are counted a megabyte at a time. An empty table gives none. Other
    columns of either table are not looked at.

    Items are indexed ``index_bytes`` of text at a time (or one longer item),
    the bound of what is broadcast; further ones take further passes.
    """
    spark = docs.sparkSession
    ship(spark)
    named = items.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text")
    ids = named.select("item_id").distinct()
    # Numbers of items need not be dense; they name them in arrays of any id type.
    ids = materialize(ids.withColumn("item", F.monotonically_increasing_id()), "search-items")
    texts = named.join(ids, "item_id").select("item", F.col("text").cast("binary").alias("text"))
    texts = materialize(texts.withColumn("size", F.length("text")), "search-item-texts")
    whole = texts.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, 2 * whole // index_bytes)
    best = None
    for k in range(blocks):
        chosen = texts.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        block = [(r.item, bytes(r.text)) for r in chosen.select("item", "text").toLocalIterator()]
        if block:
            found = _search_block(docs, block, top)
            best = found if best is None else best.unionByName(found)
    if best is None:
        best = spark.createDataFrame([], "item bigint, doc_id bigint, score bigint")
    # Two steps, so that no task meets the heaps of all tasks for an item.
    order = [F.col("score").desc(), F.col("doc_id")]
    dealt = best.withColumn("deal", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    some = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("item", "deal").orderBy(*order)))
    some = some.filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).join(ids, "item").select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), totals AS (
  SELECT count(*) FILTER (WHERE len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM words
), item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), tf AS (
  SELECT row_id, doc_id, n, term, count(*) AS tf FROM (SELECT row_id, doc_id, len(w) AS n, unnest(w) AS term FROM words)
  WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL
), df AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
), part AS (
  SELECT row_id, doc_id, term,
    CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
      * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS score
  FROM tf JOIN df USING (term), totals WHERE doc_id IS NOT NULL
), scored AS (
  SELECT item_id, row_id, doc_id, CAST(sum(score) AS BIGINT) AS score
  FROM part JOIN item_terms USING (term) GROUP BY ALL HAVING sum(score) > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored)
WHERE rank <= 10
"""
