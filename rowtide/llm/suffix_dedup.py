"""Repeated byte strings between documents, by bucket-pointer refinement.

A byte goes if a 50-byte string covers it that also starts in a document with a
smaller id. Sorting all suffixes of a corpus would move every text many times
over, so the suffixes are dealt into buckets that share a q-gram first and only
buckets that several documents share are refined:

1. Equal texts are settled by their digest; only the first of them goes on.
2. Each 50-byte window is dealt by the 24-byte gram inside it of the smallest
   hash. Equal windows choose equal grams; neighbouring windows mostly choose
   the same, so a document is a few *runs* of windows. A window over the 64-bit
   hashes of the runs' grams tells which buckets several documents share.
3. Runs in shared buckets send their bytes, which arrive sorted by gram, bytes
   and document. Equal runs stand together, so all but the first are covered as
   they pass. A bucket of suffixes is refined by the identifiers of the buckets
   of later offsets: 16 bytes, then 32 from two of those, then 50; after each
   step suffixes that no other document shares drop out. The last buckets are
   compared byte by byte.
4. Covered ranges return to their documents and are cut out.

Runs that many documents of a batch share are sent once, and the other
documents learn at once that they are covered, so a passage that a third of all
documents hold arrives once per batch. A task holds the different runs of one
gram at a time, or of a few megabytes of small ones.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rowtide.llm.batches import text_slices
from rowtide.llm.common import drop_table, finished_shuffles_go, materialize
from rowtide.llm.shingles import mix
from rowtide.session import shared_dir, ship

LENGTH = 50
GRAM = 24
SEGMENT = 1 << 19
SLICE_BYTES = 1 << 20
SEND_BYTES = 5_000_000
SALTS = 1 << 16
BUCKET_BYTES = 64_000_000
REFINE_BYTES = 2_000_000
_G1, _G2, _G3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_LOW = np.uint64((1 << 24) - 1)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number, zeros after the end."""
    x = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    x = x[:-1] | (x[1:] << np.uint64(8))
    x = x[:-2] | (x[2:] << np.uint64(16))
    x = x[:-4] | (x[4:] << np.uint64(32))
    return x[: len(data)]


@dataclass
class Runs:
    """Runs of windows that chose the same gram: text, first window, windows, hash of the gram."""

    text: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    gram: np.ndarray


def find_runs(texts: list[bytes]) -> Runs:
    """Runs of all windows of ``texts``. Long texts are cut into segments; their windows overlap the cuts."""
    parts: list[tuple[np.ndarray, ...]] = []
    todo = [
        (row, at, min(len(text), at + SEGMENT + LENGTH - 1))
        for row, text in enumerate(texts)
        for at in range(0, max(0, len(text) - LENGTH + 1), SEGMENT)
    ]
    begin = 0
    while begin < len(todo):
        end, size = begin, 0
        while end < len(todo) and (size == 0 or size + todo[end][2] - todo[end][1] <= SLICE_BYTES):
            size += todo[end][2] - todo[end][1]
            end += 1
        parts.append(_runs_of(texts, todo[begin:end]))
        begin = end
    none = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    return Runs(*(np.concatenate(c) for c in zip(*parts, strict=True))) if parts else Runs(*none)


def _runs_of(texts: list[bytes], segments: list[tuple[int, int, int]]) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(texts[row][a:b] for row, a, b in segments), np.uint8)
    sizes = np.array([b - a for _, a, b in segments])
    first = np.cumsum(sizes) - sizes
    eights = _eights(data)
    n = len(data) - GRAM + 1
    hashed = mix(eights[:n] * _G1 + eights[8 : n + 8] * _G2 + eights[16 : n + 16] * _G3)
    # The place breaks ties, the same way for equal windows.
    low = (hashed & ~_LOW) | np.arange(n, dtype=np.uint64)
    for step in (1, 2, 4, 8):
        low = np.minimum(low[:-step], low[step:])
    span = LENGTH - GRAM + 1
    low = np.minimum(low[: len(low) - (span - 16)], low[span - 16 :])
    windows = sizes - LENGTH + 1
    place = np.arange(windows.sum()) + np.repeat(first - (np.cumsum(windows) - windows), windows)
    chosen = low[place]
    new = np.ones(len(place), bool)
    new[1:] = chosen[1:] != chosen[:-1]
    new[np.cumsum(windows)[:-1]] = True
    at = np.flatnonzero(new)
    which = np.searchsorted(np.cumsum(windows), at, side="right")
    rows = np.array([row for row, _, _ in segments])
    offsets = np.array([a for _, a, _ in segments])
    return (
        rows[which],
        place[at] - first[which] + offsets[which],
        np.diff(np.append(at, len(place))),
        hashed[(chosen[at] & _LOW).astype(np.int64)],
    )


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and where each group starts in it."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, np.flatnonzero(new)


def _spread(starts: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.repeat(values, np.diff(np.append(starts, n)))


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All of start, start + 1, ... for each start and size."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


_ANNOUNCED = "gram bigint, salt int, doc_id bigint"
_SENT = "gram bigint, doc_id bigint, version int, start int, windows int, bytes binary"
_RANGES = "doc_id bigint, version int, begin int, end int"


def _rows(columns: str, values: list) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "bigint": pa.int64()}
    fields = [c.split() for c in columns.split(", ")]
    arrays = [pa.array(v, kinds[kind]) for v, (_, kind) in zip(values, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _announce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The grams of the runs of each document. Those that several documents of one batch share are known: they have a salt."""
    for batch in text_slices(batches, SEND_BYTES):
        runs = find_runs(batch.column("text").to_pylist())
        if not len(runs.text):
            continue
        who = batch.column("doc_id").to_numpy()[runs.text]
        order, first = _groups(runs.gram, who)
        gram, who = runs.gram[order[first]], who[order[first]]
        heads = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        tails = np.append(heads[1:], len(gram)) - 1
        known = _spread(heads, tails > heads, len(gram))
        salt = np.where(known, 1 + who % SALTS, 0)
        # The smallest and the largest document of a known gram speak for the batch to the others.
        ends = np.concatenate([heads[known[heads]], tails[known[heads]]])
        salt = np.concatenate([salt, np.zeros(len(ends), np.int64)]).astype(np.int32)
        at = np.concatenate([np.arange(len(gram)), ends])
        yield _rows(_ANNOUNCED, [gram[at].view(np.int64), salt, who[at]])


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs in shared buckets; what a batch can settle itself has none."""
    for batch in text_slices(batches, SEND_BYTES):
        texts = batch.column("text").to_pylist()
        runs = find_runs(texts)
        ids, versions = batch.column("doc_id").to_numpy(), batch.column("version").to_numpy()
        asked = batch.column("asked")
        rows = np.repeat(np.arange(len(texts)), asked.value_lengths().to_numpy())
        # Pairs of text and gram as one hash; one that collides is sent for nothing.
        wanted = mix(asked.flatten().to_numpy().view(np.uint64) + rows.astype(np.uint64) * _G1)
        pick = np.isin(mix(runs.gram + runs.text.astype(np.uint64) * _G1), wanted)
        text, start, windows, gram = (x[pick] for x in (runs.text, runs.start, runs.windows, runs.gram))
        if not len(text):
            continue
        content = [texts[r][a : a + w + LENGTH - 1] for r, a, w in zip(text, start, windows, strict=True)]
        owner: dict[bytes, int] = {}
        for i, c in enumerate(content):
            o = owner.setdefault(c, i)
            if ids[text[i]] < ids[text[o]]:
                owner[c] = i
        later = np.array([ids[text[owner[c]]] < ids[text[i]] for i, c in enumerate(content)])
        sent = [None if done else c for c, done in zip(content, later, strict=True)]
        # What is settled goes anywhere, so that no gram gathers it.
        anywhere = mix(ids[text].astype(np.uint64) * _G1 + start.astype(np.uint64) * _G2)
        keys = np.where(later, anywhere, gram).view(np.int64)
        yield _rows(
            _SENT, [keys, ids[text], versions[text], start.astype(np.int32), windows.astype(np.int32), sent]
        )


def refine(data: np.ndarray, windows: np.ndarray, owner: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Which windows hold 50 bytes that a window of a smaller owner holds too.

    ``windows`` are places in ``data``, ``bucket`` the bucket of each; windows
    of different buckets are never equal.
    """
    eights = _eights(data)
    n = len(data)

    def joined(ids: np.ndarray, ahead: int) -> np.ndarray:
        later = np.zeros_like(ids)
        later[: max(0, n - ahead)] = ids[ahead:]
        return mix(ids * _G1 + later * _G2 + _G3)

    ids = joined(eights, 8)
    active = np.arange(len(windows))
    for ahead in (16, LENGTH - 32):
        ids = joined(ids, ahead)
        order, heads = _groups(mix(ids[windows[active]] + bucket[active] * _G1))
        who = owner[active][order]
        several = np.minimum.reduceat(who, heads) < np.maximum.reduceat(who, heads) if len(order) else heads
        active = active[order[_spread(heads, several, len(order))]]
        if not len(active):
            return np.zeros(len(windows), bool)
    # Buckets hold equal bytes now, but for colliding identifiers: compare the bytes themselves.
    at = windows[active]
    words = [eights[at + o] for o in (0, 8, 16, 24, 32, 40, LENGTH - 8)]
    key = ids[at]
    equal = np.logical_and.reduce([w[1:] == w[:-1] for w in words])
    if not equal[key[1:] == key[:-1]].all():
        order, heads = _groups(key, *words)
    else:
        order = np.arange(len(active))
        heads = np.flatnonzero(np.append(True, ~equal))
    who = owner[active][order]
    covered = who > _spread(heads, np.minimum.reduceat(who, heads), len(order))
    out = np.zeros(len(windows), bool)
    out[active[order[covered]]] = True
    return out


def _covered_in(buckets: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Ranges of the runs of whole ``buckets`` that windows of smaller documents cover."""
    rows = pa.Table.from_batches(buckets).combine_chunks()
    gram, ids, versions, start, count = (
        rows.column(c).to_numpy() for c in ("gram", "doc_id", "version", "start", "windows")
    )
    data = np.frombuffer(b"".join(rows.column("bytes").to_pylist()), np.uint8)
    sizes = count.astype(np.int64) + LENGTH - 1
    at = np.cumsum(sizes) - sizes
    entry = np.repeat(np.arange(len(sizes)), count)
    places = _ragged(at, count.astype(np.int64))
    covered = refine(data, places, ids[entry], gram.view(np.uint64)[entry])
    same = entry[1:] == entry[:-1]
    opens = covered & ~np.append(False, covered[:-1] & same)
    closes = covered & ~np.append(covered[1:] & same, False)
    e = entry[opens]
    shift = start[e] - at[e]
    ends = places[closes] + shift + LENGTH
    return _rows(_RANGES, [ids[e], versions[e], (places[opens] + shift).astype(np.int32), ends.astype(np.int32)])


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered ranges of bytes from runs sorted by gram, bytes and document, whole buckets at a time."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None  # last: gram, bytes and smallest document of the run before
    for batch in batches:
        gram, ids, content = batch.column("gram").to_numpy(), batch.column("doc_id"), batch.column("bytes").to_pylist()
        whole, keep = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
        for i, (g, c, doc) in enumerate(zip(gram.tolist(), content, ids.to_pylist(), strict=True)):
            if c is None:
                whole[i] = True
            elif last is not None and last[:2] == (g, c) and doc > last[2]:
                # Equal runs: the smallest document comes first.
                whole[i] = True
            else:
                keep[i] = True
                last = (g, c, doc)
        if whole.any():
            some = batch.filter(pa.array(whole))
            begin, count = some.column("start").to_numpy(), some.column("windows").to_numpy()
            yield _rows(_RANGES, [some.column("doc_id"), some.column("version"), begin, begin + count + LENGTH - 1])
        at, begin = np.flatnonzero(keep), 0
        sizes = np.array([len(content[i]) for i in at], np.int64)
        runs, grams = batch.take(pa.array(at)), gram[at]
        for cut in np.flatnonzero(grams[1:] != grams[:-1]) + 1 if len(at) else []:
            size += int(sizes[begin:cut].sum())
            if size >= REFINE_BYTES:
                yield _covered_in([*held, runs.slice(begin, cut - begin)])
                held, size = [], 0
            else:
                held.append(runs.slice(begin, cut - begin))
            begin = cut
        if begin < len(at):
            held.append(runs.slice(begin))
            size += int(sizes[begin:].sum())
    if held:
        yield _covered_in(held)


def union_ranges(pairs: np.ndarray) -> np.ndarray:
    """Disjoint sorted ranges with the same union; touching ones are one."""
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.append(True, pairs[1:, 0] > reach[:-1])
    at = np.flatnonzero(new)
    return np.stack([pairs[at, 0], reach[np.append(at[1:], len(pairs)) - 1]], axis=1)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        kept, spans = [], []
        ranges = batch.column("ranges")
        all_pairs = np.stack([a.to_numpy() for a in ranges.flatten().flatten()], axis=1).astype(np.int64)
        cuts = np.cumsum(ranges.value_lengths().to_numpy())[:-1]
        for text, parts in zip(batch.column("text").to_pylist(), np.split(all_pairs, cuts), strict=True):
            pairs = union_ranges(parts)
            edges = [0, *pairs.ravel().tolist(), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            spans.append(pairs)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("sha"),
                pa.array([int((p[:, 1] - p[:, 0]).sum()) for p in spans], pa.int64()),
                pa.array([len(p) for p in spans], pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                pa.array(kept, pa.binary()),
                pa.array([[{"begin": int(a), "end": int(b)} for a, b in p] for p in spans]),
            ],
            ["doc_id", "sha", "n_removed", "n_spans", "kept_sha256", "kept", "spans"],
        )


_CUT = (
    "doc_id bigint, sha string, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, "
    "spans array<struct<begin:bigint,end:bigint>>"
)


def repeated_bytes(docs: DataFrame, texts: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row; with ``texts`` also ``kept`` and ``spans``.

    ``kept`` are the bytes that stay, ``spans`` the removed ranges of bytes. Ids
    are numbers. A null or empty text has no bytes. Texts under 50 bytes lose
    nothing. Rows without id lose nothing and cause nothing. Rows that repeat an
    id never match each other; a repeated row gets the same answer twice.
    Long texts are read in segments and judged whole. Other columns are left
    out, whatever their names.
    """
    ship(docs.sparkSession)
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit("")).cast("binary")
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    base = plain.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    base = materialize(base, "bytes-base")
    long_ones = base.filter((F.col("n_bytes") >= LENGTH) & F.col("doc_id").isNotNull())
    firsts = materialize(long_ones.groupBy("sha").agg(F.min("doc_id").alias("first")), "bytes-firsts")
    version = F.row_number().over(Window.partitionBy("first").orderBy("sha")) - 1
    firsts_named = firsts.select(F.col("first").alias("doc_id"), "sha", version.cast("int").alias("version"))
    volume = base.agg(F.sum("n_bytes")).first()[0] or 0
    # As many buckets as joins have partitions at least: with fewer, Spark would deal the texts anew.
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + volume // BUCKET_BYTES)

    # Written in buckets of ids, so that the later joins move ranges and not texts.
    name = f"bytes_{uuid.uuid4().hex}"
    named = firsts_named.withColumnRenamed("sha", "first_sha").repartition(buckets, "doc_id")
    once = plain.withColumn("sha", F.sha2("text", 256)).repartition(buckets, "doc_id").join(named.hint("merge"), "doc_id")
    # A repeated row stays here: rows of one id never cover each other.
    once = once.filter(F.col("sha") == F.col("first_sha"))
    writer = once.select("doc_id", "version", "sha", "text").write.bucketBy(buckets, "doc_id").sortBy("doc_id")
    try:
        with finished_shuffles_go(spark):
            writer.option("path", f"{shared_dir(spark)}/rowtide/{name}").saveAsTable(name)
            cut = _cut_table(spark.table(name), ("kept", "spans") if texts else ())
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        _forget(spark, f"{shared_dir(spark)}/rowtide/{name}")
    more = ("kept", "spans") if texts else ()

    rows = base.join(firsts, "sha", "left").join(cut, ["doc_id", "sha"], "left")
    copy = F.col("doc_id") > F.col("first")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return rows.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copy, none).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        *more,
    )


def _cut_table(corpus: DataFrame, more: tuple[str, ...]) -> DataFrame:
    """What :func:`_cut` says of each text of ``corpus``, written."""
    spark = corpus.sparkSession
    gram = Window.partitionBy("gram", "salt")
    announced = corpus.select("doc_id", "text").mapInArrow(_announce, _ANNOUNCED)
    announced = announced.withColumns({"low": F.min("doc_id").over(gram), "high": F.max("doc_id").over(gram)})
    shared = announced.filter((F.col("salt") > 0) | (F.col("low") < F.col("high")))
    asked = shared.groupBy("doc_id").agg(F.collect_list("gram").alias("asked"))
    asked = materialize(asked, "bytes-asked")
    sent = corpus.join(asked.hint("merge"), "doc_id").select("doc_id", "version", "text", "asked").mapInArrow(_send, _SENT)
    sent = sent.repartition("gram").sortWithinPartitions("gram", "bytes", "doc_id")
    ranges = F.collect_list(F.struct("begin", "end")).alias("ranges")
    covered = sent.mapInArrow(_covered, _RANGES).groupBy("doc_id", "version").agg(ranges)
    covered = materialize(covered, "bytes-covered")
    cut = _with(corpus, covered).select("doc_id", "sha", "text", "ranges").mapInArrow(_cut, _CUT)
    cut = cut.select("doc_id", "sha", "n_removed", "n_spans", "kept_sha256", *more).dropDuplicates(["doc_id", "sha"])
    cut = materialize(cut, "bytes-cut")
    drop_table(asked)
    drop_table(covered)
    return cut


def _with(corpus: DataFrame, by_doc: DataFrame) -> DataFrame:
    """Join on the id alone, by which the texts lie in buckets already."""
    right = by_doc.withColumnRenamed("version", "_version")
    # No equality of two columns: as a key of the join it would deal all texts anew by id and version.
    return corpus.join(right.hint("merge"), "doc_id").filter(F.col("version") - F.col("_version") == 0)


def _forget(spark, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


SQL = f"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, p, h[2 * p + 1:2 * p + {2 * LENGTH}] AS s FROM d, unnest(range(length(h) // 2 - {LENGTH - 1})) AS t(p)
), hit AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS first FROM w) WHERE doc_id > first
), island AS (
  SELECT doc_id, p, sum(gap) OVER (PARTITION BY doc_id ORDER BY p) AS g
  FROM (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= {LENGTH} THEN 0 ELSE 1 END AS gap FROM hit)
), span AS (
  SELECT doc_id, min(p) AS b, max(p) + {LENGTH} AS e FROM island GROUP BY doc_id, g
), piece AS (
  SELECT doc_id, b, e, h[2 * coalesce(lag(e) OVER w, 0) + 1:2 * b] AS before, h[2 * e + 1:] AS after
  FROM span JOIN d USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY b)
), kept AS (
  SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans, string_agg(before, '' ORDER BY b) || arg_max(after, b) AS h
  FROM piece GROUP BY doc_id
)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
