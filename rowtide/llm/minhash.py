"""Near-duplicate documents by one-permutation MinHash.

1. One hash function deals the shingles of a text into ``BANDS * ROWS`` bins
   and keeps the smallest of each. Empty bins take the value of another bin,
   found by a probing order of their own (optimal densification), so texts of
   few shingles get full signatures. Texts with equal sets form a class and go
   on as its smallest id.
2. Signatures are cut into bands; equal bands share a bucket. Each bucket
   proposes a star, its smallest id with every other member, so the pairs grow
   with the members and not with their square. Stars are verified on the full
   sets.
3. What stars cannot see is a link between two members that are not linked
   through the centre. Buckets that still hold several components are compared
   exactly, in blocks of bounded size, and return a spanning forest of their
   links. No bucket is capped.

With 32 bands of 4 rows, two texts at a similarity of 0.8 share no bucket once
in twenty million times.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowtide.llm.batches import text_slices
from rowtide.llm.common import drop_table, materialize, release
from rowtide.llm.components import components
from rowtide.llm.shingles import WordHashes, mix, shingle_sets
from rowtide.session import ship

BANDS = 32
ROWS = 4
PERCENT = 80
BLOCK = 512
GROUP_ROWS = 2_000
_GOLD = 0x9E3779B97F4A7C15


def probes(bins: int) -> np.ndarray:
    """For each bin the order in which it asks the others: fixed random permutations."""
    return np.stack([np.random.default_rng(bin).permutation(bins) for bin in range(bins)])


def signatures(row: np.ndarray, shingles: np.ndarray, rows: int, bins: int) -> np.ndarray:
    """Densified one-permutation signatures of sorted ``(row, shingle)``; rows without shingles stay zero."""
    bits = int(np.log2(bins))
    cell = row * bins + (shingles >> np.uint64(64 - bits)).astype(np.int64)
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    out = np.zeros(rows * bins, np.uint64)
    filled = np.zeros(rows * bins, bool)
    out[cell[first]] = shingles[first]  # sorted, so the first of a bin is its smallest
    filled[cell[first]] = True
    some = np.zeros(rows, bool)
    some[row] = True
    empty = np.flatnonzero(~filled & np.repeat(some, bins))
    order = probes(bins)
    for attempt in range(bins):
        if not len(empty):
            break
        asked = empty // bins * bins + order[empty % bins, attempt]
        ok = filled[asked]
        out[empty[ok]] = out[asked[ok]]
        empty = empty[~ok]
    return out.reshape(rows, bins)


def band_hashes(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit hash by band, the band's number included."""
    parts = signature.reshape(len(signature), bands, -1)
    out = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2])
    for r in range(parts.shape[2]):
        out = mix(out * np.uint64(_GOLD) + parts[:, :, r])
    return out


def _binary(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def _sketches(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in text_slices(batches):
            n = batch.num_rows
            row, hashes = shingle_sets(batch.column("text").to_pylist(), shingle, known)
            sizes = np.bincount(row, minlength=n)
            sums = []
            for salt in (1, 2):
                total = np.zeros(n, np.uint64)
                np.add.at(total, row, mix(hashes ^ np.uint64(salt * _GOLD & (2**64 - 1))))
                sums.append(pa.array(total.view(np.int64)))
            bands_of = band_hashes(signatures(row, hashes, n, bands * rows), bands).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(bands_of.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), *sums, lists],
                ["doc_id", "n_shingles", "s1", "s2", "bands"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _binary(docs).mapInArrow(
        sketch, f"doc_id {kind}, n_shingles bigint, s1 bigint, s2 bigint, bands array<bigint>"
    )


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in text_slices(batches):
            row, hashes = shingle_sets(batch.column("text").to_pylist(), shingle, known)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "shingles"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _binary(docs).mapInArrow(sets, f"doc_id {kind}, shingles array<bigint>")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``.

    Texts are linked when their sets of distinct shingles (of ``shingle``
    words, A-Z in lower case) have a Jaccard similarity of ``percent``
    hundredths or more; a component is named by its smallest id. Texts without
    words are linked with nothing. Rows that repeat an id are one document: its
    rows share a component. Rows without an id cannot be named by a link: their
    component is null and they are kept.
    """
    ship(docs.sparkSession)
    found = materialize(_sketches(docs, shingle, bands, rows), "minhash-sketches")
    worded = found.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = materialize(
        worded.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("rep")), "minhash-classes"
    )
    members = materialize(
        worded.select("doc_id", "s1", "s2", "n_shingles", "bands")
        .join(classes, ["s1", "s2", "n_shingles"])
        .select("doc_id", "rep", "n_shingles", F.when(F.col("doc_id") == F.col("rep"), F.col("bands")).alias("bands")),
        "minhash-members",
    )
    drop_table(classes)
    cells = members.filter(F.col("bands").isNotNull()).select("rep", F.explode("bands").alias("bucket"))
    centres = materialize(
        cells.groupBy("bucket").agg(F.min("rep").alias("centre"), F.count("*").alias("n")).filter("n > 1"),
        "minhash-centres",
    )
    full = materialize(cells.join(centres, "bucket"), "minhash-buckets")
    stars = materialize(
        full.filter("rep != centre").select("centre", "rep").groupBy("centre", "rep").agg(F.lit(1).alias("one")).drop("one"),
        "minhash-stars",
    )
    asked = stars.select(F.col("rep").alias("doc_id")).unionByName(stars.select(F.col("centre").alias("doc_id")))
    asked = materialize(asked.distinct(), "minhash-asked")
    wanted = docs.select("doc_id", "text").join(asked, "doc_id", "left_semi")
    sets = materialize(_sets(wanted, shingle), "minhash-sets")
    release(docs.sparkSession)

    links = materialize(_verified(stars, sets, percent), "minhash-links")
    twice = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a < z")
    again = members.select("doc_id", F.col("rep").alias("b")).join(twice.select("doc_id", "a"), "doc_id")
    links = links.unionByName(again.filter("a < b").select("a", "b"))
    rest = _rest(full, sets, components(links), percent)
    label = components(materialize(links.unionByName(rest), "minhash-all-links"))

    named = members.join(label.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    alone = found.filter((F.col("n_shingles") == 0) | F.col("doc_id").isNull())
    alone = alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return named.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The star edges whose full sets are similar enough."""
    a = sets.select(F.col("doc_id").alias("rep"), F.col("shingles").alias("x"))
    b = sets.select(F.col("doc_id").alias("centre"), F.col("shingles").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    sized = pairs.join(a, "rep").join(b, "centre").select(
        F.col("centre").alias("a"), F.col("rep").alias("b"), shared.alias("i"), (F.size("x") + F.size("y")).alias("s")
    )
    return sized.filter(100 * F.col("i") >= percent * (F.col("s") - F.col("i"))).select("a", "b")


def _rest(full: DataFrame, sets: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Links inside buckets between different components that no star has tested.

    A bucket matters if its members besides the centre, which was compared with
    all of them, lie in several components; of buckets with equal members one
    is enough. Only members outside the largest component ask. Members are
    dealt into blocks, and each pair of blocks is a small task of its own.
    """
    placed = full.filter("rep != centre").join(label.withColumnRenamed("node", "rep"), "rep", "left")
    placed = materialize(
        placed.select("bucket", "rep", "n", F.coalesce("component", "rep").alias("component")), "minhash-placed"
    )
    parts = placed.groupBy("bucket", "component").agg(
        F.count("*").alias("c"),
        F.bit_xor(F.xxhash64("rep")).alias("x"),
        F.min("rep").alias("least"),
        F.max("rep").alias("most"),
    )
    split = parts.groupBy("bucket").agg(
        F.max_by("component", "c").alias("main"),
        F.max("c").alias("m"),
        F.sum("c").alias("n"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.bit_xor("x").alias("x"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )
    same = ("n", "x", "least", "most", "low", "high")
    split = split.filter("low < high").groupBy(*same).agg(
        F.min_by(F.struct("bucket", "main", "m"), "bucket").alias("b")
    )
    open_cells = placed.drop("n").join(materialize(split.select("b.*", "n"), "minhash-open"), "bucket")
    # Members outside the largest component are compared with all members, in blocks of both.
    here, there = F.ceil((F.col("n") - F.col("m")) / BLOCK).cast("int"), F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.xxhash64("rep", F.lit("block"))

    def copies(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    asking = open_cells.filter("component != main").select(
        "bucket", "rep", "component", F.lit(True).alias("asks"), F.pmod(own, here).cast("int").alias("i"), copies(there).alias("j")
    )
    asked = open_cells.select(
        "bucket", "rep", "component", F.lit(False).alias("asks"), copies(here).alias("i"), F.pmod(own, there).cast("int").alias("j")
    )
    dealt = materialize(asking.unionByName(asked), "minhash-blocks")
    groups = max(1, dealt.count() // GROUP_ROWS)
    work = dealt.join(sets.select(F.col("doc_id").alias("rep"), "shingles"), "rep")
    work = work.withColumn("group", F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(groups)))
    kind = full.schema["rep"].dataType.simpleString()

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [
            link
            for _, block in pdf.groupby(["bucket", "i", "j"], sort=False)
            for link in _forest(block, percent)
        ]
        return pd.DataFrame(out, columns=["a", "b"])

    return work.groupBy("group").applyInPandas(compare, f"a {kind}, b {kind}")


def _forest(block: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Links between asking and asked members of different components, as few as join what they join."""
    asks = block["asks"].to_numpy()
    ids, label = block["rep"].to_numpy(), block["component"].to_numpy()
    root: dict[int, int] = {c: c for c in label}

    def find(c: int) -> int:
        while root[c] != c:
            c = root[c]
        return c

    if len(root) < 2:
        return []
    sizes = np.array([len(s) for s in block["shingles"]])
    all_shingles, at = np.unique(np.concatenate(block["shingles"].to_list()), return_inverse=True)
    rows = np.repeat(np.arange(len(ids)), sizes)
    shared = np.zeros((asks.sum(), (~asks).sum()), np.float32)
    for begin in range(0, len(all_shingles), 8192):  # counts of common shingles, some columns at a time
        some = (at >= begin) & (at < begin + 8192)
        has = np.zeros((len(ids), min(8192, len(all_shingles) - begin)), np.float32)
        has[rows[some], at[some] - begin] = 1
        shared += has[asks] @ has[~asks].T
    total = sizes[asks][:, None] + sizes[~asks][None, :]
    similar = (100 * shared >= percent * (total - shared)) & (label[asks][:, None] != label[~asks][None, :])
    mine, theirs = np.flatnonzero(asks), np.flatnonzero(~asks)
    out = []
    for x, y in zip(*np.nonzero(similar), strict=True):
        p, q = find(label[mine[x]]), find(label[theirs[y]])
        if p != q:
            root[max(p, q)] = min(p, q)
            a, b = ids[mine[x]], ids[theirs[y]]
            out.append((min(a, b), max(a, b)))
    return out


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest id; all columns unchanged.

    Of rows that repeat an id one stays. Rows without id, and texts without
    words, all stay.
    """
    kept = near_duplicates(docs, shingle, percent).filter("kept").select("doc_id").filter(F.col("doc_id").isNotNull())
    packed = docs.select(F.col("doc_id").alias("_id"), F.struct(*docs.columns).alias("row"))
    one = packed.join(kept.distinct().withColumnRenamed("doc_id", "_id"), "_id").dropDuplicates(["_id"])
    return one.unionByName(packed.filter(F.col("_id").isNull())).select("row.*")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# For shingles of two words.
SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s FROM w
), u AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i, any_value(a.n) + any_value(b.n) AS n
  FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p WHERE 100 * i >= {PERCENT} * (n - i)
), e AS (
  SELECT a AS x, b AS y FROM l UNION SELECT b, a FROM l
), r AS (
  SELECT DISTINCT x, x AS y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x
), c AS (
  SELECT x, min(y) AS least FROM r GROUP BY x
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(least, doc_id) AS component_id, coalesce(least, doc_id) = doc_id AS kept
FROM s LEFT JOIN c ON c.x = doc_id
"""
