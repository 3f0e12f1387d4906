"""Exact time-to-live deduplication.

The first delivery of an event is accepted and opens a window of ``ttl``; later
deliveries inside the window are duplicates and do not prolong it; the first
delivery at or after its end is accepted and opens the next window. So which
delivery is accepted depends on the one accepted before it, which no window
frame expresses.

There is one way for all keys, see :func:`accepted_deliveries`. No step gathers
the deliveries of a key: they are dealt by key and time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowtide.session import drop_table, materialize

DEFAULT_TTL_SECONDS = 300
_SECOND = 1_000_000


def _bucket(micros: Column, width: int) -> Column:
    """Index of the ``width``-sized bucket, in whole numbers."""
    return ((micros - F.pmod(micros, F.lit(width))) / F.lit(width)).cast("bigint")


def accepted_deliveries(
    deliveries: DataFrame,
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
    key: str = "event_id",
    at: str = "received_at",
    seq: str = "stream_seq",
    row: str | None = None,
) -> DataFrame:
    """The accepted deliveries as ``(key, at, seq)``, each once however often it was captured.

    ``(at, seq)`` identifies a delivery of a key; rows without key or time are
    passed over. ``row`` names a column with a number of the row, which is then
    returned too: of equal deliveries the smallest. The input is read twice.

    Time is cut into blocks of one ttl. A block whose predecessor is empty
    starts a new chain at its earliest arrival whatever came before; a chain of
    one block ends there. Every other accepted arrival is the earliest one at or
    after its predecessor's expiry, so each arrival points to at most one
    successor, and the accepted ones are those reachable from the chain starts:
    two steps at first, then twice as many with every round of doubled
    pointers. No step groups more than the arrivals of one key in one second,
    which the microsecond clock bounds, or the blocks of one key.
    """
    if ttl_seconds <= 0:
        raise ValueError("ttl_seconds must be positive")
    number = [] if row is None else [F.col(row).alias("row")]
    narrow = deliveries.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        F.col(key).alias("k"),
        F.unix_micros(F.col(at)).alias("at"),
        F.struct(F.col(seq).cast("bigint").alias("seq"), *number).alias("id"),
    )
    return _chains(narrow, ttl_seconds * _SECOND).select(
        F.col("k").alias(key),
        F.timestamp_micros("at").alias(at),
        F.col("id.seq").cast(deliveries.schema[seq].dataType).alias(seq),
        *([] if row is None else [F.col("id.row").alias(row)]),
    )


def _chains(narrow: DataFrame, ttl: int) -> DataFrame:
    block = _bucket(F.col("at"), ttl)
    heads = narrow.groupBy("k", block.alias("block")).agg(F.min(F.struct("at", "id")).alias("head"))
    by_key = Window.partitionBy("k").orderBy("block")
    starts = F.coalesce(F.col("block") - F.lag("block").over(by_key) > 1, F.lit(True))
    ends = F.coalesce(F.lead("block").over(by_key) - F.col("block") > 1, F.lit(True))
    begun = F.last(F.when(F.col("starts"), F.col("block")), ignorenulls=True).over(by_key)
    runs = heads.withColumns({"starts": starts, "ends": ends}).withColumn("place", F.col("block") - begun)
    runs = materialize(runs.select("k", "block", "head", "place", "ends"), "arrival-runs")
    longest = 1 + (runs.agg(F.max("place")).first()[0] or 0)
    roots = runs.filter("place = 0").select("k", "head.at", "head.id", "ends")
    if longest == 1:
        return roots.drop("ends")
    several = runs.filter("NOT (place = 0 AND ends)").select("k", "block", "head", "place")
    more = _reached(narrow, several, roots.filter("NOT ends").drop("ends"), longest, ttl)
    return roots.filter("ends").drop("ends").unionByName(more)


def _reached(narrow: DataFrame, blocks: DataFrame, roots: DataFrame, longest: int, ttl: int) -> DataFrame:
    """Arrivals on the chains from ``roots``, each once, in runs of up to ``longest`` blocks."""
    linked = narrow.withColumn("block", _bucket(F.col("at"), ttl)).join(blocks.select("k", "block"), ["k", "block"])
    linked = materialize(linked.groupBy("k", "at").agg(F.min("id").alias("id")), "chain-arrivals")

    # Successor of every arrival: the earliest arrival at or after `at + ttl`,
    # looked up in that second, then in the rest of the block, then in the next.
    none, found = F.lit(None), F.struct("at", "id")
    marks = F.array(
        F.struct((F.col("at") + ttl).alias("pos"), F.col("at").alias("src"), F.when(F.lit(False), found).alias("there")),
        F.struct(F.col("at").alias("pos"), none.cast("bigint").alias("src"), found.alias("there")),
    )
    both = linked.select("k", F.inline(marks)).withColumns(
        {"block": _bucket(F.col("pos"), ttl), "sec": _bucket(F.col("pos"), _SECOND)}
    )
    from_pos = (
        Window.partitionBy("k", "block", "sec").orderBy("pos").rangeBetween(0, Window.unboundedFollowing)
    )
    in_second = both.withColumn("hit", F.min("there").over(from_pos)).filter(F.col("src").isNotNull())
    later = Window.partitionBy("k", "block").orderBy("sec").rowsBetween(1, Window.unboundedFollowing)
    next_second = (
        both.groupBy("k", "block", "sec")
        .agg(F.min("there").alias("first"))
        .withColumn("next_in_block", F.min("first").over(later))
        .drop("first")
    )
    next_block = blocks.filter("place > 0").select(
        "k", (F.col("block") - 1).alias("block"), F.col("head").alias("next_head")
    )
    jump = (
        in_second.join(next_second, ["k", "block", "sec"], "left")
        .join(next_block, ["k", "block"], "left")
        .select("k", "src", F.coalesce("hit", "next_in_block", "next_head").alias("dst"))
        .filter(F.col("dst").isNotNull())
    )
    jump = materialize(jump, "chain-jump")
    drop_table(linked)

    def follow(reached: DataFrame, pointers: DataFrame) -> DataFrame:
        stepped = reached.select("k", F.col("at").alias("src")).join(pointers, ["k", "src"])
        return stepped.select("k", "dst.at", "dst.id")

    def compose(first: DataFrame, then: DataFrame) -> DataFrame:
        onward = then.select("k", F.col("src").alias("_at"), F.col("dst").alias("far"))
        met = first.withColumn("_at", F.col("dst.at")).join(onward, ["k", "_at"])
        return met.select("k", "src", F.col("far").alias("dst"))

    one = follow(roots, jump)
    if longest == 2:
        return roots.unionByName(one)
    reached, covered = roots.unionByName(one).unionByName(follow(one, jump)), 3
    pointers = compose(compose(jump, jump), jump)
    while covered < longest:
        reached = materialize(reached, f"chain-reached-{covered}")
        pointers = materialize(pointers, f"chain-jump-{covered}")
        reached, covered = reached.unionByName(follow(reached, pointers)), covered * 2
        pointers = compose(pointers, pointers)
    return reached


def near_windows(windows: DataFrame, ttl_seconds: int, key: str, at: str) -> DataFrame:
    """``_k, _block, _starts``: the windows that matter for arrivals of a key in a ttl-sized block.

    Windows of a key are disjoint, so at most one begins in a block and at most
    three matter for one.
    """
    began = F.unix_micros(at)
    block = _bucket(began, ttl_seconds * _SECOND)
    spread = windows.select(
        F.col(key).alias("_k"), began.alias("_at"), F.explode(F.array(block - 1, block, block + 1)).alias("_block")
    )
    return spread.groupBy("_k", "_block").agg(F.collect_list("_at").alias("_starts"))


def flag_deliveries(
    deliveries: DataFrame,
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
    key: str = "event_id",
    at: str = "received_at",
    seq: str = "stream_seq",
    published: str | None = None,
    windows: DataFrame | None = None,
    row: str | None = None,
) -> DataFrame:
    """Add ``dedup``: ``miss`` for accepted deliveries, ``hit`` for duplicates.

    ``published`` names a boolean column; a delivery whose publishing failed is
    a miss when it arrives outside a window, but opens none, so that its
    redelivery is published. Of identical rows, a delivery captured several
    times, one is the delivery and the others are hits. Rows without a key or an
    arrival time get NULL.

    ``windows`` are deliveries accepted earlier, as ``(key, at)``: the windows
    they opened go on. A delivery inside one is a hit. So is one less than a ttl
    before one: the event has gone out already, and windows stay disjoint.

    ``row`` names a column with a number of the row, the same in every read
    (a written table's); then the rows themselves are only joined with their
    labels by that number. Without it they are joined by delivery, and copies
    counted, which orders them. Neither goes by key, so a hot key spreads over
    all tasks.
    """
    keyed = F.col(key).isNotNull() & F.col(at).isNotNull()
    ok = F.lit(True) if published is None else F.coalesce(F.col(published), F.lit(True))
    ids = [key, at, seq] + ([] if row is None else [row])
    narrow = deliveries.filter(keyed).select(*ids, ok.alias("_ok"))
    if windows is not None:
        narrow = _judge_by(narrow, windows, ttl_seconds, key, at)
    fresh = narrow if windows is None else narrow.filter(~F.col("_known"))
    accepted = accepted_deliveries(fresh.filter("_ok"), ttl_seconds, key, at, seq, row)
    if published is not None:
        # Read twice below, once per kind of delivery.
        accepted = materialize(accepted, "accepted")
    labels = accepted.select(*ids, F.lit("miss").alias("_label"))
    if row is not None:
        if published is not None:
            failed = _flag_failed(fresh.filter("NOT _ok").select(*ids), accepted, ttl_seconds, key, at, seq)
            labels = labels.unionByName(failed.filter("dedup = 'miss'").select(*ids, F.col("dedup").alias("_label")))
        marked = deliveries.join(labels.select(row, "_label"), row, "left")
        return marked.select(
            *deliveries.columns, F.when(keyed, F.coalesce("_label", F.lit("hit"))).alias("dedup")
        )
    # The copies of a delivery meet in the join anyway.
    copy = F.row_number().over(Window.partitionBy(key, at, seq).orderBy(F.lit(0)))
    marked = deliveries.filter(keyed & ok).join(labels, [key, at, seq], "left").withColumn("_copy", copy)
    out = marked.select(
        *deliveries.columns,
        F.when(F.col("_label").isNotNull() & (F.col("_copy") == 1), "miss").otherwise("hit").alias("dedup"),
    ).unionByName(deliveries.filter(~keyed).withColumn("dedup", F.lit(None).cast("string")))
    if published is None:
        return out
    failed = deliveries.filter(keyed & ~ok)
    known = accepted if windows is None else accepted.select(key, at, seq).unionByName(
        windows.select(key, at, F.lit(None).cast(deliveries.schema[seq].dataType).alias(seq))
    )
    return out.unionByName(_flag_failed(failed, known, ttl_seconds, key, at, seq))


def _judge_by(narrow: DataFrame, windows: DataFrame, ttl_seconds: int, key: str, at: str) -> DataFrame:
    """Add ``_known``: the delivery falls into a window known already, or would publish shortly before one."""
    ttl, now = ttl_seconds * _SECOND, F.unix_micros(at)
    near = near_windows(windows, ttl_seconds, key, at)
    met = narrow.withColumns({"_k": F.col(key), "_block": _bucket(now, ttl)}).join(near, ["_k", "_block"], "left")
    inside = F.exists("_starts", lambda w: (w <= now) & (now < w + ttl))
    before = F.exists("_starts", lambda w: (now < w) & (w < now + ttl)) & F.col("_ok")
    known = F.coalesce(inside | before, F.lit(False))
    return materialize(met.select(*narrow.columns, known.alias("_known")), "judged")


def _flag_failed(
    failed: DataFrame, accepted: DataFrame, ttl_seconds: int, key: str, at: str, seq: str
) -> DataFrame:
    """Label deliveries that opened no window by the window they fall into.

    At most one delivery is accepted per key and ttl-sized block, so the window
    covering a moment was opened in the same block or the one before.
    """
    ttl = ttl_seconds * _SECOND
    block = _bucket(F.unix_micros(at), ttl)
    anchor = F.struct(F.unix_micros(at).alias("at"), F.col(seq).alias("seq"))
    none = F.lit(None)
    spans = F.array(
        F.struct(block.alias("_block"), anchor.alias("here"), none.alias("before")),
        F.struct((block + 1).alias("_block"), none.alias("here"), anchor.alias("before")),
    )
    covers = (
        accepted.select(key, F.inline(spans))
        .groupBy(key, "_block")
        .agg(F.max("here").alias("here"), F.max("before").alias("before"))
    )
    now = F.struct(F.unix_micros(at).alias("at"), F.col(seq).alias("seq"))
    covered = (F.col("here") < now) | (F.col("before.at") + ttl > F.unix_micros(at))
    return (
        failed.withColumn("_block", _bucket(F.unix_micros(at), ttl))
        .join(covers, [key, "_block"], "left")
        .select(
            *failed.columns,
            F.when(F.coalesce(covered, F.lit(False)), "hit").otherwise("miss").alias("dedup"),
        )
    )


def first_deliveries(
    deliveries: DataFrame, key: str = "event_id", at: str = "received_at", seq: str = "stream_seq"
) -> DataFrame:
    """The earliest delivery per key (a ttl without end) as ``(key, at, seq)``, once.

    Two partial aggregates find it, so a hot key shrinks to one row per map task
    before the shuffle, unlike with a window function.
    """
    there = deliveries.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
    arrivals = there.groupBy(key, at).agg(F.min(seq).alias(seq))
    first = arrivals.groupBy(key).agg(F.min(at).alias("_at"), F.min_by(seq, at).alias(seq))
    return first.select(key, F.col("_at").alias(at), seq)
