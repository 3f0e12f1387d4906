"""Conversation structure repair by a run-length dynamic program.

A conversation is a string of symbols, one per row: the initial of its role and
its fault. Repairing it is the cheapest path through four states (nothing yet,
after system, after user, after assistant) from the first row to a legal end,
so a row is a 4 x 4 matrix of costs under (min, +). Equal consecutive symbols
are one run; a run of n rows takes log2(n) products with cached powers of its
matrix. The choices are unrolled afterwards, along the costs still to go.

Matrices can be multiplied in parts, so no task needs a whole conversation. Rows
are dealt by range; of a conversation that spans several parts the parts are
multiplied first, then joined in order. Only narrow rows take part in this;
texts join the finished edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cache
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rowtide.llm.common import SPACE_CHARS, materialize, table_bytes
from rowtide.session import ship

DELETE, INSERT, REROLE, UNFINISHED = 4, 3, 3, 3
ROLES = "sua"
FULL_ROLE = {2: "user", 3: "assistant"}
LEGAL = frozenset(("su", "ua", "au"))
GONE = 8  # the symbol of a row that must be deleted; others are 2 * role + 1 if truncated, role 3 being any other
NEVER = 1 << 50
BROADCAST_BYTES = 32_000_000

# By state: the next one by a user or assistant row, which is what can be inserted or renamed to.
_NEXT = (2, 2, 3, 2)
# By role: the states that a row of this role may follow, with the next state.
_KEEP = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
# Costs to go behind the last row: inserts up to a legal end.
END = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]
UNIT: Matrix = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(min(x + b[k][j] for k, x in enumerate(row)), NEVER) for j in range(4)) for row in a)


def _apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(min(x + y for x, y in zip(row, v)), NEVER) for row in a)


@cache
def power(symbol: int, k: int) -> Matrix:
    """The matrix of ``2 ** k`` rows of a symbol; any inserts come before a row."""
    if k:
        half = power(symbol, k - 1)
        return _times(half, half)
    row = [[NEVER] * 4 for _ in range(4)]
    for state in range(4):
        row[state][state] = DELETE
        if symbol != GONE:
            more = UNFINISHED * (symbol % 2)
            row[state][_NEXT[state]] = min(row[state][_NEXT[state]], REROLE + more)
            if state in _KEEP[symbol // 2]:
                row[state][_KEEP[symbol // 2][state]] = more
    inserts = [list(r) for r in UNIT]
    for state in range(4):
        inserts[state][_NEXT[state]] = INSERT
    once = tuple(map(tuple, inserts))
    return _times(_times(once, once), tuple(map(tuple, row)))


def advance(runs: Iterable[tuple[int, int]], costs: Vector) -> Vector:
    """Costs to go before ``runs`` of (symbol, length), last run first, from those behind them."""
    for symbol, length in runs:
        k = 0
        while length >> k:
            if length >> k & 1:
                costs = _apply(power(symbol, k), costs)
            k += 1
    return costs


def product(runs: Iterable[tuple[int, int]]) -> Matrix:
    """The matrix of a part of a conversation."""
    out = UNIT
    for symbol, length in runs:
        k = 0
        while length >> k:
            if length >> k & 1:
                out = _times(out, power(symbol, k))
            k += 1
    return out


def unroll(
    runs: Sequence[tuple[int, int]], end: Vector, state: int, last: bool = True
) -> tuple[list[tuple[str, int, int]], int]:
    """The cheapest edits as ``(letters, times, state after)`` and the last state.

    Of equal costs the ASCII-least letter is taken first, row by row. Deletions
    of a run that must go are one entry; nothing is gained by inserting before
    them. ``last`` adds the inserts behind the last row.
    """
    before = [end]
    for run in reversed(runs):
        before.append(advance([run], before[-1]))
    before.reverse()
    edits: list[tuple[str, int, int]] = []
    for number, (symbol, length) in enumerate(runs):
        if symbol == GONE:
            edits.append(("D", length, state))
            continue
        step, inside = power(symbol, 0), [before[number + 1]]
        while len(inside) < length:
            inside.append(_apply(step, inside[-1]))
        more, keep = UNFINISHED * (symbol % 2), _KEEP[symbol // 2]
        now = before[number]
        for behind in reversed(inside):
            while True:
                if DELETE + behind[state] == now[state]:
                    edits.append(("D", 1, state))
                elif INSERT + now[_NEXT[state]] == now[state]:
                    state = _NEXT[state]
                    edits.append(("I", 1, state))
                    continue
                elif state in keep and more + behind[keep[state]] == now[state]:
                    state = keep[state]
                    edits.append(("K", 1, state))
                else:
                    state = _NEXT[state]
                    edits.append(("R", 1, state))
                break
            now = behind
    while last and end[state]:
        state = _NEXT[state]
        edits.append(("I", 1, state))
    return edits, state


# -- parts of conversations, as rows ---------------------------------------------------------

_ROW = ["part", "conv_id", "turn", "role", "digest", "symbol", "times"]


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    return chain.from_iterable(zip(*(c.to_pylist() for c in b.columns)) for b in batches)


def _blocks(batches: Iterable[pa.RecordBatch], width: int = 2) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Consecutive rows of one part and conversation, by their first ``width`` columns."""
    return groupby(_rows(batches), key=lambda row: row[:width])


def _symbols(rows: Iterable[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Copies of a row behind its first must go."""
    for symbol, times in rows:
        if symbol != GONE and times > 1:
            yield symbol, 1
            yield GONE, times - 1
        else:
            yield symbol, times


def collapse(symbols: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    return [(symbol, sum(n for _, n in run)) for symbol, run in groupby(symbols, key=lambda x: x[0])]


def _edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The matrix of the first and the last conversation of each part; no other can go on elsewhere."""
    out, held = [], None
    for key, rows in _blocks(batches):
        runs = collapse(_symbols((r[5], r[6]) for r in rows))
        if held is None or held[0][0] != key[0]:
            out += [held] if held and held[2] else []
            out.append((key, runs, False))
        held = (key, runs, bool(held) and held[0][0] == key[0])
    out += [held] if held and held[2] else []
    yield pa.RecordBatch.from_pydict(
        {
            "part": pa.array([k[0] for k, _, _ in out], pa.int32()),
            "conv_id": pa.array([k[1] for k, _, _ in out]),
            "step": pa.array([list(chain(*product(runs))) for _, runs, _ in out], pa.list_(pa.int64())),
        }
    )


def _ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The costs behind each part of conversations that have several."""
    parts, convs, ends = [], [], []
    for conv, blocks in _rows(batches):
        costs = END
        for block in reversed(blocks):
            parts.append(block["part"])
            convs.append(conv)
            ends.append(list(costs))
            step = block["step"]
            costs = _apply(tuple(tuple(step[i : i + 4]) for i in range(0, 16, 4)), costs)
    yield pa.RecordBatch.from_pydict(
        {"part": pa.array(parts, pa.int32()), "conv_id": pa.array(convs), "end": pa.array(ends, pa.list_(pa.int64()))}
    )


def _leads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each part leads from each state."""
    parts, convs, leads = [], [], []
    for (part, conv), rows in _blocks(batches):
        rows = list(rows)
        runs, end = collapse(_symbols((r[5], r[6]) for r in rows)), tuple(rows[0][7])
        parts.append(part)
        convs.append(conv)
        leads.append([unroll(runs, end, state, last=False)[1] for state in range(4)])
    yield pa.RecordBatch.from_pydict(
        {"part": pa.array(parts, pa.int32()), "conv_id": pa.array(convs), "lead": pa.array(leads, pa.list_(pa.int32()))}
    )


def _starts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state before each part of conversations that have several, and whether it is the last."""
    parts, convs, starts, last = [], [], [], []
    for conv, blocks in _rows(batches):
        state = 0
        for number, block in enumerate(blocks):
            parts.append(block["part"])
            convs.append(conv)
            starts.append(state)
            last.append(number == len(blocks) - 1)
            state = block["lead"][state]
    yield pa.RecordBatch.from_pydict(
        {"part": pa.array(parts, pa.int32()), "conv_id": pa.array(convs), "start": pa.array(starts, pa.int32()), "last": last}
    )


def _cost(letter: str, times: int, symbol: int) -> int:
    if letter in "DI":
        return (DELETE if letter == "D" else INSERT) * times
    return REROLE * (letter == "R") + UNFINISHED * (symbol % 2)


def _edited(conv_type: pa.DataType) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["part", "at", "conv_id", "edit", "times", "cost", "role", "turn", "old_role", "digest"]
    kinds = [
        pa.int32(), pa.int64(), conv_type, pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()
    ]

    def edited(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in names]

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)
            for column in out:
                column.clear()
            return batch

        for (part, conv), rows in _blocks(batches):
            rows = list(rows)
            end, start, last = rows[0][7:10]
            end = END if end is None else tuple(end)
            symbols = [list(_symbols([(r[5], r[6])])) for r in rows]
            edits, _ = unroll(collapse(chain(*symbols)), end, start or 0, last is not False)
            edits = iter(edits)
            left = 0  # deletions of a run that later rows still take
            at = 0
            for row, own in zip(rows, symbols):
                for symbol, times in own:
                    while times:
                        if left:
                            letter, n = "D", min(left, times)
                            left -= n
                        else:
                            letter, n, state = next(edits)
                            if letter == "D" and n > times:
                                left, n = n - times, times
                        key = (None, None, None) if letter == "I" else row[2:5]
                        role = row[3] if letter == "K" else FULL_ROLE.get(state) if letter in "IR" else None
                        for column, value in zip(out, (part, at, conv, letter, n, _cost(letter, n, symbol), role, *key)):
                            column.append(value)
                        at += 1
                        times -= n * (letter != "I")
            for letter, n, state in edits:
                for column, value in zip(out, (part, at, conv, letter, n, INSERT * n, FULL_ROLE[state], None, None, None)):
                    column.append(value)
                at += 1
            if len(out[0]) > 10_000:
                yield flush()
        yield flush()

    return edited


# -- the operator ------------------------------------------------------------------------------


def _key(name: str, alias: str) -> Column:
    """A value that may be null as a join and sort key: equal to itself, nulls first."""
    return F.struct(F.col(name).alias("v")).alias(alias)


def _prepared(rows: DataFrame) -> DataFrame:
    """``c, t, role, digest, text``: null roles and texts are one space."""
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        _key("conv_id", "c"),
        F.struct(F.col("turn").cast("bigint").alias("v")).alias("t"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.md5(text.cast("binary")).alias("digest"),
        text.alias("text"),
    )


_PLACE = ["c", "t", "role", "digest"]


def _faults(prepared: DataFrame) -> DataFrame:
    """``c, t, role, digest, times, fault`` per distinct row, equal ones counted.

    A row is a duplicate unless its turn is the first that has its role and
    text; the search for the first turn is a partial aggregate, and the join
    back goes by turn, so rows of one much repeated text spread.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE_CHARS))
    fault = F.when(trimmed == "", "blank").when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated")
    rows = prepared.withColumn("fault", fault).groupBy(*_PLACE, "fault").agg(F.count("*").alias("times"))
    rows = materialize(rows, "turns")
    first = rows.groupBy("c", "role", "digest").agg(F.min("t").alias("t")).withColumn("first", F.lit(True))
    marked = rows.join(first, _PLACE, "left")
    late = F.col("first").isNull() & F.coalesce(F.col("fault") != "blank", F.lit(True))
    return marked.select(*_PLACE, "times", F.when(late, "duplicate").otherwise(F.col("fault")).alias("fault"))


def _planned(ordered: DataFrame, plan: DataFrame | None) -> DataFrame:
    """Rows in order within their part, with the plan of their conversation if it spans parts."""
    rows = ordered.select("part", "c", "t", "role", "digest", "symbol", "times")
    if plan is not None:
        rows = rows.join(F.broadcast(plan) if table_bytes(plan) <= BROADCAST_BYTES else plan, ["c", "part"], "left")
    else:
        none = [("end", "array<bigint>"), ("start", "int"), ("last", "boolean")]
        rows = rows.withColumns({n: F.lit(None).cast(k) for n, k in none})
    dealt = rows.repartition("part").sortWithinPartitions("part", "c", "t", "role", "digest")
    flat = dealt.select(
        "part", F.col("c.v").alias("conv_id"), F.col("t.v").alias("turn"), "role", "digest", "symbol", "times", "end", "start", "last"
    )
    return flat


def _split_plan(ordered: DataFrame, kind: str) -> DataFrame | None:
    """``c, part, end, start, last`` for the parts of conversations that have several; None if there are none."""

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("c", F.struct(F.col("conv_id").alias("v"))).drop("conv_id")

    def by_conversation(df: DataFrame, value: str) -> DataFrame:
        blocks = F.sort_array(F.collect_list(F.struct("part", value))).alias("blocks")  # at most one a part
        return df.groupBy("c").agg(blocks).filter(F.size("blocks") > 1).select(F.col("c.v").alias("conv_id"), "blocks")

    edges = keyed(_planned(ordered, None).mapInArrow(_edges, f"part int, conv_id {kind}, step array<bigint>"))
    ends = by_conversation(edges, "step").mapInArrow(_ends, f"part int, conv_id {kind}, end array<bigint>")
    ends = materialize(keyed(ends), "turn-ends")
    if ends.isEmpty():
        return None
    ready = ends.withColumns({"start": F.lit(None).cast("int"), "last": F.lit(None).cast("boolean")})
    split = _planned(ordered, ready).filter(F.col("end").isNotNull())
    leads = keyed(split.mapInArrow(_leads, f"part int, conv_id {kind}, lead array<int>"))
    starts = by_conversation(leads, "lead").mapInArrow(_starts, f"part int, conv_id {kind}, start int, last boolean")
    return materialize(ends.join(keyed(starts), ["c", "part"]), "turn-plan")


def repair_edits(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with their faults, and the cheapest edits in order."""
    ship(prepared.sparkSession)
    initial = F.substring("role", 1, 1)
    role = F.when(F.col("role") == "", 3)
    for number, letter in enumerate(ROLES):
        role = role.when(initial == letter, number)
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), GONE).otherwise(
        2 * role.otherwise(3) + (F.col("fault").eqNullSafe("truncated")).cast("int")
    )
    faults = _faults(prepared).withColumn("symbol", symbol)
    ordered = faults.repartitionByRange("c", "t", "role", "digest").withColumn("part", F.spark_partition_id())
    ordered = materialize(ordered, "turn-parts")
    conv = ordered.schema["c"].dataType["v"].dataType
    kind = conv.simpleString()
    plan = _split_plan(ordered, kind)
    schema = (
        f"part int, at bigint, conv_id {kind}, edit string, times bigint, cost bigint, role string, "
        "turn bigint, old_role string, digest string"
    )
    edits = _planned(ordered, plan).mapInArrow(_edited(to_arrow_type(conv)), schema)
    return ordered, materialize(edits, "turn-edits")


def repaired_rows(prepared: DataFrame, edits: DataFrame) -> DataFrame:
    """Every edit with its text: ``conv_id, part, at, edit, times, role, old_role, text``, to be sorted by part and at.

    Kept and renamed rows have their text, inserted ones an empty one, deleted
    ones none. Copies of a row have one text.
    """
    texts = prepared.dropDuplicates(_PLACE)
    placed = edits.select(
        _key("conv_id", "c"),
        F.struct(F.col("turn").alias("v")).alias("t"),
        F.col("old_role"),
        "digest",
        F.struct("part", "at", "edit", "times", "role").alias("e"),
    )
    own = texts.withColumnRenamed("role", "old_role")
    joined = placed.filter(F.col("e.edit").isin("K", "R")).join(own, ["c", "t", "old_role", "digest"])
    rest = placed.filter(F.col("e.edit").isin("I", "D")).withColumn("text", F.when(F.col("e.edit") == "I", ""))
    both = joined.select("c", "old_role", "e", "text").unionByName(rest.select("c", "old_role", "e", "text"))
    return both.select(F.col("c.v").alias("conv_id"), "e.*", "old_role", "text")


def _digests(conv_type: pa.DataType) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs, audits, hashes, pairs = [], [], [], []
        for (conv,), rows in _blocks(batches, 1):
            letters, whole, empty, illegal, before = [], hashlib.sha256(), True, 0, None
            for _, edit, times, role, old_role, text in rows:
                letters.append(edit * times)
                if edit != "D":
                    whole.update((b"" if empty else b"\n") + role.encode() + b":" + text)
                    empty = False
                if edit != "I":
                    initial = old_role[:1]
                    illegal += times - 1 + (before is not None and before + initial not in LEGAL)
                    before = initial
            convs.append(conv)
            audits.append("".join(letters))
            hashes.append(whole.hexdigest())
            pairs.append(illegal)
        yield pa.RecordBatch.from_pydict(
            {"conv_id": pa.array(convs, conv_type), "audit": audits, "repaired_sha256": hashes, "illegal": pa.array(pairs, pa.int64())},
        )

    return digests


def structure_report(rows: DataFrame, originals: DataFrame) -> DataFrame:
    """What was wrong with each conversation of ``originals`` and how ``rows``, what is left of it, is repaired.

    Returns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``. The audit and the digest of a conversation are one string
    each over all its rows, so a last pass streams each conversation's edits in
    order; it holds one text and the audit.

    Rows of a conversation are taken by turn, nulls first; those of one turn by
    role, then by the MD5 digest of their text, so equal rows are neighbours.
    Null roles and texts count as one space; a null ``conv_id`` is a
    conversation like others. An empty role has no initial and is never legal.
    Conversations without rows have zeros, an empty audit and the digest of
    nothing. Empty tables give none. Texts of any length and other columns go
    unchanged or unread.
    """
    prepared = _prepared(rows)
    faults, edits = repair_edits(prepared)
    blank, late = F.col("fault") == "blank", F.col("fault") == "duplicate"
    more = F.when(blank, 0).when(late, F.col("times")).otherwise(F.col("times") - 1)
    counts = faults.groupBy("c").agg(
        F.sum(F.when(blank, F.col("times")).otherwise(0)).alias("blank"),
        F.sum(more).alias("duplicate"),
        F.count_if(F.col("fault") == "truncated").alias("truncated"),
    )
    turns = faults.filter(F.col("t.v").isNotNull()).select("c", F.col("t.v").alias("turn")).distinct()
    gaps = turns.groupBy("c").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    costs = edits.groupBy(_key("conv_id", "c")).agg(F.sum("cost").alias("cost"))
    conv = faults.schema["c"].dataType["v"].dataType
    streamed = (
        repaired_rows(prepared, edits)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "at")
        .select("conv_id", "edit", "times", "role", "old_role", F.col("text").cast("binary").alias("text"))
        .mapInArrow(
            _digests(to_arrow_type(conv)),
            f"conv_id {conv.simpleString()}, audit string, repaired_sha256 string, illegal bigint",
        )
        .select(_key("conv_id", "c"), "audit", "repaired_sha256", "illegal")
    )
    out = originals.select(_key("conv_id", "c")).distinct()
    for part in (counts, gaps, costs, streamed):
        out = out.join(part, "c", "left")
    zeros = [F.coalesce(n, F.lit(0)).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(
        F.col("c.v").alias("conv_id"),
        *zeros,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def repair_conversations(rows: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, place, role, text, edit``, ``place`` counting from 1.

    See :func:`structure_report` for order and nulls. ``edit`` is K, R or I.
    """
    prepared = _prepared(rows)
    kept = repaired_rows(prepared, repair_edits(prepared)[1]).filter("edit <> 'D'")
    # Places by part first, so that no task orders a whole conversation.
    inside = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("at"))
    sizes = kept.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(_key("conv_id", "c"), "part", F.coalesce(before, F.lit(0)).alias("first"))
    placed = kept.withColumn("inside", inside).withColumn("c", F.struct(F.col("conv_id").alias("v")))
    return placed.join(sizes, ["c", "part"]).select(
        "conv_id", (F.col("first") + F.col("inside")).alias("place"), "role", "text", "edit"
    )


def damage(rows: DataFrame) -> DataFrame:
    """Planted faults by ``crc32('conv_id:turn') % 20``, nulls read as one space.

    0 drops the row, 1 empties its text, 2 takes the full stops, exclamation and
    question marks out of it, 3 repeats the row, 4 makes its role ``user``.
    """
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(place.cast("binary")) % 20
    text = F.coalesce("text", space)
    marked = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"), kind.alias("kind"))
    changed = marked.filter("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return changed.drop("copy")
