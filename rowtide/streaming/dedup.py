"""Deduplication held in streaming state."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rowtide.operators.dedup import DEFAULT_TTL_SECONDS
from rowtide.session import ship


KEEP_SECONDS = 86_400
STATE_SHARDS = 4_096
_NEVER = np.iinfo(np.int64).min


def label_arrivals(at: np.ndarray, opens: np.ndarray, expiry: int, ttl: int) -> tuple[np.ndarray, int]:
    """Which of one key's ordered arrivals are new, and the window's end after them.

    ``expiry`` is the end of the last window known, which began a ttl earlier.
    Arrivals before that beginning are told apart among themselves and leave the
    window as it is. The rest jumps from one accepted arrival to the first one
    after its window.
    """
    new = np.zeros(len(at), dtype=bool)
    if expiry != _NEVER:
        old = int(np.searchsorted(at, expiry - ttl, side="left"))
        if old:
            new[:old], _ = label_arrivals(at[:old], opens[:old], _NEVER, ttl)
    i = int(np.searchsorted(at, expiry, side="left"))
    while i < len(at):
        new[i] = True
        if opens[i]:
            expiry = int(at[i]) + ttl
            i = int(np.searchsorted(at, expiry, side="left"))
        else:
            i += 1
    return new, expiry


def label_among(at: np.ndarray, opens: np.ndarray, known: np.ndarray, ttl: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of one key's ordered arrivals are new beside known windows, and all windows after them."""
    new = np.zeros(len(at), dtype=bool)
    free = np.ones(len(at), dtype=bool)
    if len(known):
        place = np.searchsorted(known, at, side="right")
        free = (place == 0) | (at >= known[np.maximum(place - 1, 0)] + ttl)
        follows = known[np.minimum(place, len(known) - 1)]
        free &= ~opens | (place == len(known)) | (at + ttl <= follows)
    chosen = np.flatnonzero(free)
    new[chosen], _ = label_arrivals(at[chosen], opens[chosen], _NEVER, ttl)
    return new, np.sort(np.concatenate([known, at[new & opens]]))


@contextmanager
def data_batches_only(spark: SparkSession) -> Iterator[None]:
    """Start queries so that only data makes them run a batch.

    State that times out on the clock otherwise asks for one batch after the
    other, and a query that is to end with its input never ends. Timeouts are
    then looked at along with the next data.
    """
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _label_shard(
    keys: list, micros: np.ndarray, seqs: np.ndarray, opens: np.ndarray, known: dict, ttl: int
) -> tuple[np.ndarray, dict]:
    """Which arrivals of many keys are new, and all windows of these keys after them.

    ``known`` maps a key to its windows. A key that comes once and has none, as
    most do, opens one without a look of its own.
    """
    place: dict = {}
    codes = np.fromiter((place.setdefault(k, len(place)) for k in keys), np.int64, len(keys))
    names = list(place)
    order = np.lexsort((seqs, micros, codes))
    ends = np.cumsum(np.bincount(codes, minlength=len(names)))
    at, opening = micros[order], opens[order]
    new = np.ones(len(keys), dtype=bool)
    windows = {}
    start = 0
    for name, end in zip(names, ends.tolist()):
        if end - start == 1 and name not in known:
            windows[name] = at[start:end][opening[start:end]]
        else:
            before = np.array(known.get(name, []), dtype=np.int64)
            new[order[start:end]], windows[name] = label_among(at[start:end], opening[start:end], before, ttl)
        start = end
    return new, windows


def dedup_ttl_stream(
    events: DataFrame,
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
    keep_seconds: int = KEEP_SECONDS,
    key: str = "event_id",
    at: str = "received_at",
    seq: str = "stream_seq",
    published: str | None = None,
    shards: int = STATE_SHARDS,
) -> DataFrame:
    """Add ``dedup`` (``miss`` or ``hit``) to a stream of keyed deliveries.

    The state of a key is the set of its windows, disjoint, in order; those that
    began more than ``keep_seconds`` before the last are forgotten. An arrival in
    a known window is a hit, also one earlier than the last batch; so is one less
    than a ttl before a known window, since its event went out already. The state
    is removed when the key has not come for ``keep_seconds`` of processing time;
    no row is dropped for being late. A log that is replayed slower than it was
    recorded needs a longer time. Start a query that ends with its input under
    :func:`data_batches_only`. The rows of a key in a batch meet in one worker;
    :func:`rowtide.streaming.flow.dedup_stream` spreads them.

    Keys are dealt into ``shards`` by hash and a shard is one group with one
    state, as a call of the function costs about a thousand times the labelling
    of a key that comes once. A batch rewrites the state of the shards it meets,
    so few large batches are best. The number is fixed once a query has started.
    """
    if keep_seconds < ttl_seconds:
        raise ValueError("keep_seconds must be at least ttl_seconds")
    ttl, keep = ttl_seconds * 1_000_000, keep_seconds * 1_000_000
    columns = events.columns
    output = T.StructType([*events.schema.fields, T.StructField("dedup", T.StringType())])
    listed = T.StructType(
        [
            T.StructField("keys", T.ArrayType(events.schema[key].dataType)),
            T.StructField("starts", T.ArrayType(T.LongType())),
            T.StructField("seen", T.ArrayType(T.LongType())),
        ]
    )

    def label(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames), ignore_index=True)
        names = rows[key].astype(object).where(rows[key].notna(), None).tolist()
        micros = rows[at].astype("datetime64[us]").astype("int64").to_numpy()
        opens = np.ones(len(rows), dtype=bool)
        if published is not None:
            opens = rows[published].fillna(True).to_numpy(dtype=bool)
        now = state.getCurrentProcessingTimeMs()
        here, known, kept = set(names), {}, []
        for name, start, seen in zip(*(state.get if state.exists else ([], [], []))):
            if seen + keep_seconds * 1000 <= now:
                continue
            if name in here:
                known.setdefault(name, []).append(start)
            else:
                kept.append((name, start, seen))
        new, windows = _label_shard(names, micros, rows[seq].to_numpy(), opens, known, ttl)
        for name, starts in windows.items():
            if len(starts):
                kept += [(name, start, now) for start in starts[starts >= starts[-1] - keep].tolist()]
        if kept:
            state.update(tuple(list(values) for values in zip(*kept)))
            state.setTimeoutDuration(keep_seconds * 1000)
        elif state.exists:
            state.remove()
        rows["dedup"] = np.where(new, "miss", "hit")
        yield rows[[*columns, "dedup"]]

    ship(events.sparkSession)
    shard = F.pmod(F.xxhash64(key), F.lit(shards))
    return events.withColumn("_shard", shard).groupBy("_shard").applyInPandasWithState(
        label, output, listed, "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def dedup_watermark(events: DataFrame, delay: str = "5 minutes", key: str = "event_id") -> DataFrame:
    """Approximate deduplication with Spark's own operator.

    Keeps the row it meets first and forgets a key only once the watermark has
    passed, so it may drop a redelivery that the exact rule accepts. Cheaper, as
    it runs without Python.
    """
    return events.withWatermark("received_at", delay).dropDuplicatesWithinWatermark([key])


def check_complete(query: StreamingQuery) -> None:
    """Raise when the watermark of :func:`dedup_watermark` made a finished query drop rows.

    Only progress that Spark still remembers is looked at
    (``spark.sql.streaming.numRecentProgressUpdates``). The exact rule needs no
    watermark and drops nothing.
    """
    dropped = sum(
        op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators
    )
    if dropped:
        raise RuntimeError(f"{dropped} deliveries came later than the watermark delay allows")
