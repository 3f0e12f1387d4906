"""Near-duplicate lines by a deletion-neighbourhood join.

A line is its sequence of words. It is removed if an earlier line of the corpus
(smaller document id, then smaller line number) is the same or differs by one
word replaced, added or left out. One edit may make another statement of a
short line, so lines under ``MIN_WORDS`` words are removed as exact copies only.
Judged on the input: an earlier line counts even if it is removed itself.

1. One scan gives each line with a word a hash, and hashes of its first and its
   second half. Equal lines meet in a partial aggregate and go on as their
   earliest.
2. One edit leaves one half untouched, so only lines of ``MIN_WORDS`` or more
   words that share a half with another can have a near one; the others emit no
   variants.
3. Those lines emit all their variants with one word left out, as hashed keys
   with the word's place, and the line itself. Lines with equal variants at
   equal places differ by a replaced word; a variant that equals a whole line
   differs by a word more. Per key only the earliest line matters, so groups
   of any size are minima of partial aggregates and never pairs.
4. The proposed pair is verified by the edit distance of its words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowtide.llm.batches import text_slices
from rowtide.llm.common import materialize, release
from rowtide.llm.shingles import WordHashes, mix
from rowtide.session import ship

MIN_WORDS = 5
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 2**64)
_ORDER = "decimal(38,0)"
_LINES_A_ROW = 2**31


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out) if n else out


class LineHashes:
    """Polynomial hashes of any part of any line of a batch, from prefix sums modulo 2**64."""

    def __init__(self, words: Sequence[bytes], known: WordHashes) -> None:
        self.words = mix(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(self.words * _powers(_BASE, len(words)))])
        self.back = _powers(_INVERSE, len(words) + 1)

    def raw(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.sums[end] - self.sums[begin]

    def part(self, begin: np.ndarray, end: np.ndarray, salt: int | np.ndarray = 0) -> np.ndarray:
        """Hash of the words from ``begin`` to ``end``; equal words, number and salt give equal hashes."""
        size = (end - begin).astype(np.uint64)
        return mix(self.raw(begin, end) * self.back[begin] + mix(size + np.asarray(salt, np.uint64)))

    def without(self, begin: np.ndarray, end: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hash of a line without its word ``at``; equals :meth:`part` of the shorter line."""
        raw = self.raw(begin, at) + self.raw(at + 1, end) * np.uint64(_INVERSE)
        return mix(raw * self.back[begin] + mix((end - begin - 1).astype(np.uint64)))


def _lines(texts: Sequence[bytes], least: int) -> tuple[list[bytes], np.ndarray]:
    """Words of all lines of at least ``least`` words, and rows of (text, line number, words)."""
    words: list[bytes] = []
    found: list[tuple[int, int, int]] = []
    for row, text in enumerate(texts):
        for number, line in enumerate(text.split(b"\n")):
            own = line.split()
            if len(own) >= least:
                words += own
                found.append((row, number, len(own)))
    return words, np.array(found, np.int64).reshape(-1, 3)


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with an id: ``doc_id``, a hash of the text that tells apart rows that repeat an id, and its bytes."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.filter(F.col("doc_id").isNotNull())
    return keyed.select("doc_id", F.xxhash64(text).alias("version"), text.cast("binary").alias("text"))


def _occurrences(docs: DataFrame) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in text_slices(batches):
            words, found = _lines(batch.column("text").to_pylist(), 1)
            hashes = LineHashes(words, known)
            row, number, n = found.T
            end = np.cumsum(n)
            begin = end - n
            # Halves as a line of its own length, and as the longer one of a pair whose lengths differ by one.
            halves = []
            for length, more in ((n, 0), (n - 1, 1)):
                cut = length // 2
                halves.append(hashes.part(begin, begin + cut, 4 * length + 1))
                halves.append(hashes.part(begin + cut + more, end, 4 * length + 2))
            columns = [hashes.part(begin, end), *halves]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    batch.column("version").take(pa.array(row)),
                    pa.array(number.astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                    *[pa.array(c.view(np.int64)) for c in columns],
                ],
                ["doc_id", "version", "number", "n", "line", "p0", "s0", "p1", "s1"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{c} bigint" for c in ("line", "p0", "s0", "p1", "s1"))
    return _keyed(docs).mapInArrow(scan, f"doc_id {kind}, version bigint, number int, n int, {longs}")


def _order() -> Column:
    """Document id and line number as one number, of a type that hash aggregation can hold."""
    return (F.col("doc_id").cast("decimal(20,0)") * F.lit(_LINES_A_ROW) + F.col("number")).cast(_ORDER)


def earliest_lines(docs: DataFrame, occurrences: DataFrame) -> DataFrame:
    """``line, n, first``: for each distinct line that occurs again or has an earlier near one, where the first of them is."""
    lines = occurrences.groupBy("line", "n").agg(
        F.min(_order()).alias("first"),
        F.count("*").alias("times"),
        *[F.min(c).alias(c) for c in ("p0", "s0", "p1", "s1")],
    )
    lines = materialize(lines, "lines")
    cells = lines.filter(F.col("n") >= MIN_WORDS).select(
        "line",
        "n",
        F.inline(F.array(*[F.struct(F.col(c).alias("half"), F.lit(c[1] == "0").alias("own")) for c in ("p0", "s0", "p1", "s1")])),
    )
    shared = cells.groupBy("half").agg(F.count("*").alias("lines"), F.max(F.col("own").cast("int")).alias("own"))
    shared = materialize(shared.filter("lines > 1 AND own = 1").select("half"), "line-halves")
    release(docs.sparkSession)
    some = cells.join(shared, "half").select("line", "n").distinct()
    asked = materialize(lines.select("line", "n", "first").join(some, ["line", "n"]), "line-candidates")
    release(docs.sparkSession)
    near = _near(_words(docs, asked))
    out = lines.join(near, ["line", "n"], "left").filter((F.col("times") > 1) | F.col("near").isNotNull())
    out = materialize(out.select("line", "n", F.coalesce("near", "first").alias("first")), "lines-first")
    release(docs.sparkSession)
    return out


def _words(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The words (as hashes) and variants of the asked lines, read at their first place."""
    place = asked.select(
        F.floor(F.col("first") / _LINES_A_ROW).cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        F.pmod("first", F.lit(_LINES_A_ROW).cast(_ORDER)).cast("int").alias("number"),
        "line",
    )
    place = place.groupBy("doc_id").agg(F.collect_list(F.struct("number", "line")).alias("asked"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in text_slices(batches):
            wanted = [{(a["number"], a["line"]) for a in x} for x in batch.column("asked").to_pylist()]
            words, found = _lines(batch.column("text").to_pylist(), MIN_WORDS)
            hashes = LineHashes(words, known)
            row, number, n = found.T
            end = np.cumsum(n)
            begin = end - n
            line = hashes.part(begin, end).view(np.int64)
            pick = [i for i, (r, k, h) in enumerate(zip(row, number, line, strict=True)) if (k, h) in wanted[r]]
            pick = np.array(pick, np.int64)
            lists, variants = [], []
            for b, e in zip(begin[pick], end[pick], strict=True):
                at = np.arange(b, e)
                lists.append(hashes.words[b:e].view(np.int64))
                variants.append(hashes.without(np.full(e - b, b), np.full(e - b, e), at).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(line[pick]),
                    pa.array(n[pick].astype(np.int32)),
                    pa.array(lists, pa.list_(pa.int64())),
                    pa.array(variants, pa.list_(pa.int64())),
                ],
                ["line", "n", "words", "variants"],
            )

    # The same plan at every size: texts are dealt by id and merged.
    texts = _keyed(docs).join(place.hint("merge"), "doc_id").select("doc_id", "text", "asked")
    read = texts.mapInArrow(scan, "line bigint, n int, words array<bigint>, variants array<bigint>")
    read = read.dropDuplicates(["line", "n"]).join(asked, ["line", "n"])
    out = materialize(read, "line-words")
    release(docs.sparkSession)
    return out


def _near(lines: DataFrame) -> DataFrame:
    """``line, n, near``: the earliest line within one edit, where that is earlier than the line itself."""
    cells = lines.select("line", "n", "first", F.posexplode("variants").alias("at", "key")).unionByName(
        lines.select("line", "n", "first", F.lit(-1).alias("at"), F.col("line").alias("key"))
    )
    cells = materialize(cells, "line-variants")
    replaced = cells.filter("at >= 0").groupBy("key", "at", "n").agg(F.min("first").alias("best"), F.count("*").alias("m"))
    replaced = materialize(replaced.filter("m > 1").drop("m"), "line-replaced")
    whole = F.min(F.when(F.col("at") < 0, F.col("first"))).alias("whole")
    left_out = F.min(F.when(F.col("at") >= 0, F.col("first"))).alias("left_out")
    other = cells.groupBy("key").agg(whole, left_out).filter("whole IS NOT NULL AND left_out IS NOT NULL")
    other = materialize(other, "line-other")
    release(lines.sparkSession)
    longer = F.when(F.col("at") < 0, F.col("left_out")).otherwise(F.col("whole"))
    found = (
        cells.join(replaced, ["key", "at", "n"])
        .select("line", "n", "first", "best")
        .unionByName(cells.join(other, "key").select("line", "n", "first", longer.alias("best")))
        .filter(F.col("best") < F.col("first"))
        .groupBy("line", "n")
        .agg(F.min("best").alias("near"))
    )
    words = lines.select("line", "n", "words")
    theirs = lines.select(F.col("first").alias("near"), F.col("words").alias("theirs"))
    both = found.join(words, ["line", "n"]).join(theirs, "near")
    return both.filter(_one_edit(F.col("words"), F.col("theirs"))).select("line", "n", "near")


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two sequences differ by at most one element replaced, added or left out."""
    longer, shorter = F.when(F.size(a) >= F.size(b), a).otherwise(b), F.when(F.size(a) >= F.size(b), b).otherwise(a)
    n = F.size(longer)
    # Elements before the first difference.
    same = F.array_position(F.zip_with(longer, shorter, lambda x, y: F.coalesce(x != y, F.lit(True))), True) - 1
    same = F.when(same < 0, n).otherwise(same).cast("int")
    rest = n - same - 1
    tail = F.slice(longer, F.least(same + 2, n + 1), F.greatest(rest, F.lit(0)))
    skip = F.when(n == F.size(shorter), same + 2).otherwise(same + 1)
    return (same >= n) | (
        (n - F.size(shorter) <= 1) & (tail == F.slice(shorter, skip, F.greatest(rest, F.lit(0))))
    )


def line_verdicts(docs: DataFrame) -> DataFrame:
    """``doc_id, version, removed``: for rows that lose lines, the sorted numbers of those lines from 0."""
    ship(docs.sparkSession)
    occurrences = materialize(_occurrences(docs), "line-occurrences")
    first = earliest_lines(docs, occurrences)
    late = occurrences.select("doc_id", "version", "number", "line", "n").join(first, ["line", "n"])
    late = late.filter(_order() > F.col("first"))
    lost = late.groupBy("doc_id", "version").agg(F.sort_array(F.collect_set("number")).alias("removed"))
    out = materialize(lost, "lines-removed")
    release(docs.sparkSession)
    return out


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the later ones of near-duplicate lines, and ``n_lines`` and ``n_removed``.

    The text is split at line feeds and the lines left are joined by them. Lines
    of fewer than five words go as exact copies only, those without a word
    never. A null text stays null, with no
    lines; an empty one has one empty line. Rows without id lose nothing and
    remove nothing. Rows that repeat an id with the same text are one document:
    their lines are no copies of each other. Columns of the two added names are
    replaced; all others pass through.
    """
    rest = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    text = F.coalesce("text", F.lit(""))
    packed = docs.select(
        F.col("doc_id").alias("_id"),
        F.xxhash64(text).alias("_version"),
        F.col("text").alias("_text"),
        F.struct(*[c for c in rest if c != "text"]).alias("_row"),
    )
    lost = line_verdicts(docs).select(
        F.col("doc_id").alias("_id"), F.col("version").alias("_version"), F.col("removed").alias("_removed")
    )
    joined = packed.join(lost.hint("merge"), ["_id", "_version"], "left")
    lines = F.split("_text", "\n")
    joined = joined.select("_row", "_text", "_removed", lines.alias("_lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_removed"))
    kept = F.array_join(F.transform(left, lambda i: F.col("_lines")[i]), "\n")
    out = joined.select(
        "_row.*",
        F.when(F.col("_removed").isNull(), F.col("_text")).otherwise(kept).alias("text"),
        F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines")).alias("n_lines"),
        F.when(F.col("_removed").isNull(), 0).otherwise(F.size("_removed")).alias("n_removed"),
    )
    return out.select(*rest, "n_lines", "n_removed")


def clean_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with near-duplicate lines dropped, in the columns of ``docs``.

    A row that has lost lines and has no word left is dropped: all of it was a
    copy. ``n_chars``, where there is one, follows the text.
    """
    out = drop_lines(docs).filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new = F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", new)
    return out.select(*docs.columns)


SQL = rf"""
WITH raw AS (
  SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents
), split AS (
  SELECT doc_id, generate_subscripts(ls, 1) - 1 AS no, unnest(ls) AS line FROM raw
), lines AS (
  SELECT doc_id, no, doc_id::HUGEINT * 2147483648 + no AS ord,
    list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM split
), once AS (
  SELECT w, len(w) AS n, min(ord) AS first FROM lines WHERE len(w) >= 1 GROUP BY w
), u AS (
  SELECT * FROM once WHERE n >= {MIN_WORDS}
), v AS (
  SELECT w, n, first, i, list_concat(w[:i - 1], w[i + 1:]) AS key FROM u, unnest(generate_series(1, n)) AS t(i)
), sub AS (
  SELECT key, i, n, min(first) AS best FROM v GROUP BY ALL
), near AS (
  SELECT v.w, min(sub.best) AS best FROM v JOIN sub USING (key, i, n) GROUP BY 1
  UNION ALL SELECT v.w, min(u.first) FROM v JOIN u ON v.key = u.w GROUP BY 1
  UNION ALL SELECT u.w, min(v.first) FROM u JOIN v ON v.key = u.w GROUP BY 1
), e AS (
  SELECT w, min(first) AS first FROM (SELECT w, first FROM once UNION ALL SELECT w, best FROM near) GROUP BY w
), gone AS (
  SELECT doc_id, list(no) AS nos FROM lines JOIN e USING (w) WHERE ord > e.first GROUP BY doc_id
), done AS (
  SELECT doc_id, len(ls) AS n_lines, coalesce(len(nos), 0) AS n_removed,
    array_to_string([ls[i + 1] FOR i IN range(len(ls)) IF NOT list_contains(coalesce(nos, []), i)], chr(10)) AS t
  FROM raw LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, CAST(n_lines AS INTEGER) AS n_lines, CAST(n_removed AS INTEGER) AS n_removed, sha256(t) AS kept_sha256 FROM done
"""
