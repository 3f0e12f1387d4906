"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed hash. A source whose target is ``p`` times its size
and a rest is taken ``p`` times whole, and once more below a threshold on the
hash. The threshold is found without sorting: words are summed by source and
hash bucket, the bucket in which the running sum passes the rest is the
boundary, and only its documents are summed again by the next bits of the hash.
A larger budget has a larger threshold, so the mixes of growing budgets are
nested. All of it is column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowtide.llm.common import drop_table, materialize, table_bytes, words_of

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
BITS, LEVELS = 12, 5
BROADCAST_BYTES = 32_000_000
SALTS = 64


def _key(source: str) -> Column:
    """The source as a value that is never null and sorts by code point, null last."""
    name = F.col(source).cast("string")
    return F.struct(name.isNull().alias("none"), F.coalesce(name, F.lit("")).alias("name"))


def _hash(doc_id: str, text: str) -> Column:
    """60 bits of a digest of id and text."""
    whole = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, BITS * LEVELS // 4), 16, 10).cast("bigint")


def join_by_source(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``per_source``, one row a source, without gathering a source in one task.

    A small table is broadcast; a larger one goes to every document by source
    and one of ``SALTS`` parts of its hash.
    """
    if table_bytes(per_source) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(per_source), "s")
    dealt = per_source.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", (F.col("h") % SALTS).cast("int")).join(dealt, ["s", "salt"]).drop("salt")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """``s, source_size, rank`` (from 0, by code point, null last), ranked range by range."""
    sums = sizes.groupBy("s").agg(F.sum("size").alias("source_size"))
    dealt = sums.repartitionByRange(F.col("s")).withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "mix-sources")
    parts = dealt.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row per partition
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("s"))
    ranked = dealt.withColumn("inside", inside).join(parts, "part")
    return ranked.select("s", "source_size", (F.col("first") + F.col("inside") - 1).alias("rank"))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``s, source_size, target``: ``share`` of all words dealt by weight, at most ``most`` times a source's size.

    The excess of a source at its bound goes to the others by weight, until none
    is above. The level of words per weight only rises, by one aggregate a round.
    """
    if not 0 <= share <= most:
        raise ValueError("share must be between 0 and most")
    ranked = ranked_sources(sizes)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = materialize(ranked.withColumn("weight", weight), "mix-weights")
    bound = F.col("source_size") * F.lit(float(most))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = bound < F.lit(level) * F.col("weight")
        full, free, n = table.agg(
            F.sum(F.when(above, bound)), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)
        ).first()
        if n == capped or free is None:
            break
        level, capped = (share * total - (full or 0.0)) / free, n
    target = F.when(bound < F.lit(level) * F.col("weight"), bound).otherwise(F.lit(level) * F.col("weight"))
    return table.select("s", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, rests: DataFrame) -> DataFrame:
    """``s, below``: the documents of a source with a hash under ``below`` have nearest to ``rest`` words.

    ``rests`` has ``s, rest``, ``rest`` being less than the source's words. Each
    round sums the documents at the boundary by ``BITS`` further bits of their
    hash; those of one hash are taken together or not at all.
    """
    rows = join_by_source(sizes.filter("size > 0"), materialize(rests.filter("rest > 0"), "mix-rests"))
    found, kept = None, []
    for level in range(LEVELS):
        bucket = F.shiftright("h", BITS * (LEVELS - 1 - level)).bitwiseAND(F.lit(2**BITS - 1))
        sums = rows.groupBy("s", bucket.alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("h").alias("low"), F.max("h").alias("high"), F.first("rest").alias("rest")
        )
        # At most 4,096 rows a source, however many documents it has.
        before = F.sum("words").over(
            Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        )
        sums = sums.withColumn("before", F.coalesce(before, F.lit(0)))
        at = (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))
        edge = materialize(sums.filter(at), "mix-edge")
        over = F.col("before") + F.col("words") - F.col("rest")
        below = F.col("low") + F.when(over < F.col("rest") - F.col("before"), 1).otherwise(0)
        done = edge.filter("low = high").select("s", below.alias("below"))
        found = done if found is None else found.unionByName(done)
        left = edge.filter("low < high").select(
            "s", F.col("bucket").alias("edge"), (F.col("rest") - F.col("before")).alias("rest")
        )
        if level == LEVELS - 1 or left.isEmpty():
            break
        inside = join_by_source(rows.drop("rest").withColumn("bucket", bucket), left)
        rows = materialize(inside.filter("bucket = edge").select("s", "h", "size", "rest"), "mix-boundary")
        kept.append(rows)
    found = materialize(found, "mix-thresholds")
    for table in kept:
        drop_table(table)
    return found


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row of ``docs``.

    ``size`` is the number of words; null and empty texts have none and are
    taken with 0. Sources weigh ``weights`` in turn, by code point, null last,
    as a source of its own. ``taken`` is ``size`` times the copies the mix
    takes: whole passes of the source and one more below its threshold. A
    source's taken words differ from its target by at most half the words of
    the documents at its threshold, which share one hash. Rows equal in id and
    text share their hash and so their decision; rows of one id and different
    texts, rows without id and very long texts are decided like any others.
    Equal input gives equal output, whatever its order or partitions. An empty
    table gives none. Other columns of ``docs`` are not looked at.
    """
    sizes = docs.select(
        F.col(doc_id).alias("doc_id"),
        _key(source).alias("s"),
        F.size(words_of(F.col(text))).cast("bigint").alias("size"),
        _hash(doc_id, text).alias("h"),
    )
    sizes = materialize(sizes, "mix-sizes")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = source_targets(sizes, weights, share, most).withColumn("passes", passes)
    targets = materialize(
        targets.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")), "mix-targets"
    )
    limits = thresholds(sizes, targets.select("s", "rest"))
    per_source = materialize(
        targets.join(limits, "s", "left").withColumn("below", F.coalesce("below", F.lit(0))), "mix-plan"
    )
    copies = F.col("passes") + (F.col("h") < F.col("below")).cast("bigint")
    return join_by_source(sizes, per_source).select(
        "doc_id",
        F.when(~F.col("s.none"), F.col("s.name")).alias("source"),
        "size",
        "source_size",
        "target",
        (F.col("size") * copies).alias("taken"),
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size,
    CAST('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, ''))[:15] AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, row_number() OVER w AS k, coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0) AS full_words,
    sum(weight) OVER after AS free
  FROM s WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST),
    before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), l AS (
  SELECT arg_min((1.5::DOUBLE * total - full_words) / free, k) AS level
  FROM o, (SELECT sum(source_size) AS total FROM s)
  WHERE 2.0::DOUBLE * source_size >= (1.5::DOUBLE * total - full_words) / free * weight
), t AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, level * weight) AS target,
    CASE WHEN source_size > 0 THEN CAST(floor(least(2.0::DOUBLE * source_size, level * weight) / source_size) AS BIGINT) ELSE 0 END AS passes
  FROM s, l
), u AS (
  SELECT source, h, sum(size) AS words FROM d WHERE size > 0 GROUP BY source, h
), c AS (
  SELECT u.source, h, words, sum(words) OVER (PARTITION BY u.source ORDER BY h) AS upto,
    t.target - t.passes * t.source_size AS rest
  FROM u JOIN t ON u.source IS NOT DISTINCT FROM t.source
), more AS (
  SELECT source, h FROM c WHERE rest > 0 AND (upto <= rest OR (upto - words <= rest AND upto - rest < rest - (upto - words)))
)
SELECT doc_id, d.source, size, source_size, target, size * (passes + CASE WHEN more.h IS NULL THEN 0 ELSE 1 END) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
LEFT JOIN more ON more.h = d.h AND more.source IS NOT DISTINCT FROM d.source
"""
