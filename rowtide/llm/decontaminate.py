"""Benchmark decontamination with spaced seeds.

Three fixed masks of six words each are laid over every position of training
and test texts. Words under the gaps of a mask do not matter, so a passage with
some words replaced still agrees with the test text under one mask. Equal seed
hashes propose an alignment (item, diagonal); each is verified on the words
themselves: a window of ``SPAN`` aligned words of which all but ``REPLACED``
are equal. Where an edge of the text or of the item leaves fewer aligned words,
as many must be equal; a short item found whole, or a short document that lies
whole in an item, counts with as many replaced words as :func:`tolerance` says.

The masks are lossless: whatever three of sixteen words are replaced, one of
them hits (see :func:`tolerance`, which tests that for every length). All of it
is column expressions.
"""

from __future__ import annotations

from functools import cache, reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from rowtide.functions.settle import settled
from rowtide.llm.common import materialize, table_bytes, words_of

# The word positions each mask looks at.
MASKS = ((0, 1, 2, 3, 4, 7), (0, 1, 2, 5, 6, 7), (0, 2, 3, 4, 5, 6))
SPAN = 16
REPLACED = 3
MIN_WORDS = 8
BROADCAST_BYTES = 32_000_000


@cache
def tolerance(words: int) -> int:
    """Replaced words that the masks are sure to find in ``words`` aligned ones, three in sixteen at most."""
    found = 0
    for k in range(1, REPLACED * words // SPAN + 1):
        for gaps in combinations(range(words), k):
            if not any(not {at + o for o in m} & {*gaps} for m in MASKS for at in range(words - m[-1])):
                return found
        found = k
    return found


def _hashes(text: str) -> Column:
    return F.transform(words_of(F.lower(F.col(text))), lambda w: F.xxhash64(w))


def _seeds(rows: DataFrame, *keys: str) -> DataFrame:
    """``keys``, ``at`` and ``seed`` for each mask at each word position of column ``_h``.

    Words are final before they are filtered and listed, since Spark would read
    them again for each filter, its own on the length of a list included. Seeds
    are made per listed position, which is compiled, unlike functions over lists.
    """
    # The shortest mask ends one word earlier than the others; its last place looks at the padding of those.
    padded = settled(rows.select(*keys, F.concat("_h", F.array(F.lit(0).cast("bigint"))).alias("_p")), "_p")
    last = F.size("_p") - 1 - (min(m[-1] for m in MASKS) + 1)
    placed = padded.filter(F.size("_p") > MIN_WORDS).select(*keys, "_p", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    under = [F.xxhash64(F.lit(m), *[F.col("_p")[F.col("at") + o] for o in mask]) for m, mask in enumerate(MASKS)]
    return placed.select(*keys, "at", F.explode(F.array(*under)).alias("seed"))


def _text_key() -> list[Column]:
    """Texts are known by two hashes: copies are looked at as one."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(text, F.lit(1)).alias("k2")]


def contaminated_texts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``k1, k2, items`` for each text that overlaps a test item; equal items count as their smallest id."""
    tests = benchmark.filter(F.col("item_id").isNotNull()).select("item_id", _hashes("text").alias("_h"))
    tests = tests.filter(F.size("_h") >= MIN_WORDS).groupBy("_h").agg(F.min("item_id").alias("item"))
    tests = materialize(tests.withColumn("n", F.size("_h")), "benchmark-items")
    seeds = materialize(_seeds(tests, "item").withColumnRenamed("at", "item_at"), "benchmark-seeds")
    # Benchmarks are small beside the corpus, but nothing says how small: beyond the bound Spark joins by shuffle.
    small = table_bytes(seeds) <= BROADCAST_BYTES and table_bytes(tests) <= BROADCAST_BYTES
    near = F.broadcast if small else lambda df: df

    hashed = docs.select(*_text_key(), _hashes("text").alias("_h"))
    hits = (
        _seeds(hashed, "k1", "k2")
        .join(near(seeds), "seed")
        .groupBy("k1", "k2", "item", (F.col("at") - F.col("item_at")).alias("diagonal"))
        .agg(F.count("*").alias("seeds"))
    )
    hits = materialize(hits, "benchmark-hits")
    keys = materialize(hits.select("k1", "k2").distinct(), "benchmark-keys")
    # A text that many rows share is verified once.
    texts = docs.select(*_text_key(), "text").join(keys, ["k1", "k2"], "left_semi")
    texts = texts.groupBy("k1", "k2").agg(F.min("text").alias("text")).select("k1", "k2", _hashes("text").alias("words"))
    aligned = hits.join(near(tests), "item").join(texts, ["k1", "k2"])
    ahead, behind = F.greatest("diagonal", F.lit(0)), F.greatest(-F.col("diagonal"), F.lit(0))
    both = F.least(F.size("words") - ahead, F.col("n") - behind)
    aligned = aligned.select(
        "k1",
        "k2",
        "item",
        "n",
        F.size("words").alias("words"),
        F.slice("words", ahead + 1, F.greatest(both, F.lit(0))).alias("a"),
        F.slice("_h", behind + 1, F.greatest(both, F.lit(0))).alias("b"),
    )
    equal = aligned.select("k1", "k2", "item", "n", "words", F.zip_with("a", "b", lambda x, y: (x == y).cast("int")).alias("e"))

    def total(e: Column) -> Column:
        return F.aggregate(e, F.lit(0), lambda s, x: s + x)

    size = F.size("e")
    equals = total(F.col("e"))
    starts = F.sequence(F.lit(1), size - SPAN + 1)
    windowed = F.exists(starts, lambda s: total(F.slice("e", s, SPAN)) >= SPAN - REPLACED)
    allowed = reduce(lambda out, n: F.when(size == n, tolerance(n)).otherwise(out), range(MIN_WORDS, SPAN), F.lit(0))
    whole = (size >= MIN_WORDS) & ((size == F.col("n")) | (size == F.col("words"))) & (equals >= size - allowed)
    edge = (F.col("n") >= SPAN) & (equals >= SPAN - REPLACED)
    overlap = F.when(size >= SPAN, windowed).otherwise(whole | edge)
    return equal.filter(overlap).groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item")).alias("items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_items, items, kept`` per row of ``docs``.

    Words are compared in lower case. ``items`` lists the overlapping test
    items by id, equal items as their smallest; ``kept`` is false if there are
    any. Test items of fewer than eight words are too short to be evidence;
    those of 8 to 15 must be found whole, with as many replaced words as the
    masks are sure to find, and so must documents of 8 to 15 words that are a
    part of an item. Of an item cut by an edge of the document 13 equal words
    are enough. Null and empty texts overlap nothing. Copies of a
    text get equal answers; rows without id are answered too; test items
    without id or text are passed over.
    """
    found = contaminated_texts(docs, benchmark)
    rows = docs.select("doc_id", *_text_key()).join(found, ["k1", "k2"], "left")
    items = F.coalesce("items", F.array().cast(found.schema["items"].dataType))
    return rows.select("doc_id", items.alias("items")).select(
        "doc_id", F.size("items").alias("n_items"), "items", (F.size("items") == 0).alias("kept")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without an overlap, all their columns unchanged."""
    found = contaminated_texts(docs, benchmark).select("k1", "k2")
    packed = docs.select(F.struct(*docs.columns).alias("row"), *_text_key())
    return packed.join(found, ["k1", "k2"], "left_anti").select("row.*")


SQL = rf"""
WITH dw AS (
  SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS word, len(w) AS n
  FROM (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM documents)
), items AS (
  SELECT w, min(item_id) AS item_id
  FROM (SELECT item_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL)
  WHERE len(w) >= {MIN_WORDS} GROUP BY w
), bw AS (
  SELECT item_id, generate_subscripts(w, 1) AS q, unnest(w) AS word, len(w) AS m FROM items
), same AS (
  SELECT doc_id, item_id, p, q, p - q AS d, n, m FROM dw JOIN bw USING (word)
), runs AS (
  SELECT doc_id, item_id, n, m, least(n - greatest(d, 0), m - greatest(-d, 0)) AS size,
    count(*) OVER (PARTITION BY doc_id, item_id, d ORDER BY p RANGE BETWEEN CURRENT ROW AND {SPAN - 1} FOLLOWING) AS c,
    count(*) OVER (PARTITION BY doc_id, item_id, d) AS total
  FROM same
), found AS (
  SELECT DISTINCT doc_id, item_id FROM runs
  WHERE (m >= {SPAN} AND c >= {SPAN - REPLACED})
     OR (size BETWEEN {MIN_WORDS} AND {SPAN - 1} AND size IN (n, m) AND total >= size - CASE size {{cases}} ELSE 0 END)
)
SELECT doc_id, CAST(count(item_id) AS INTEGER) AS n_items,
  coalesce(list_sort(list(item_id) FILTER (item_id IS NOT NULL)), []) AS items, count(item_id) = 0 AS kept
FROM documents LEFT JOIN found USING (doc_id) GROUP BY doc_id
""".format(cases=" ".join(f"WHEN {n} THEN {tolerance(n)}" for n in range(MIN_WORDS, SPAN)))
