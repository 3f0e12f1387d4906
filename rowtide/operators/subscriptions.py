"""Many subject patterns at once: which subscribers hear which events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MOST_SHAPES = 1000


def _shapes(subscriptions: DataFrame, pattern: str) -> DataFrame:
    """Add ``_shape`` (``l`` for a literal token, ``*`` for any, a last ``>``) and ``_key``, the literal tokens."""
    tokens = F.split(F.trim(pattern), r"\.", -1)
    last = F.element_at(tokens, -1) == ">"
    fixed = F.when(last, F.slice(tokens, 1, F.size(tokens) - 1)).otherwise(tokens)
    marks = F.array_join(F.transform(fixed, lambda t: F.when(t == "*", "*").otherwise("l")), "")
    key = F.array_join(F.filter(fixed, lambda t: t != "*"), ".")
    return subscriptions.withColumns({"_shape": F.concat(marks, F.when(last, ">").otherwise("")), "_key": key})


def _fits(tokens: Column, shape: str) -> Column:
    """The key of a subject under a shape, NULL where its tokens do not fit."""
    fixed = shape.removesuffix(">")
    enough = F.size(tokens) > len(fixed) if shape.endswith(">") else F.size(tokens) == len(fixed)
    literal = [F.get(tokens, F.lit(i)) for i, mark in enumerate(fixed) if mark == "l"]
    key = F.concat_ws(".", *literal) if literal else F.lit("")
    whole = ~F.exists(tokens, lambda t: t == "")
    return F.when(enough & whole, F.struct(F.lit(shape).alias("_shape"), key.alias("_key")))


def matching_subscribers(
    events: DataFrame, subscriptions: DataFrame, subject: str = "target_subject", pattern: str = "pattern"
) -> DataFrame:
    """Every event with every subscription that matches its subject, one row per pair.

    ``*`` stands for one token, a last ``>`` for one or more. Patterns with
    literals at the same places have one shape, and there are few of those
    however many patterns: an event is looked up once per shape, by its tokens at
    those places, in an equality join. The events are read once and no pattern is
    tried on an event it cannot match. A pattern without literals, or a subject
    much subscribed to, makes one hot key, whose rows Spark broadcasts or splits.
    Null patterns and subjects match nothing.
    """
    shaped = _shapes(subscriptions.filter(F.col(pattern).isNotNull()), pattern)
    found = [r._shape for r in shaped.select("_shape").distinct().limit(MOST_SHAPES + 1).collect()]
    if len(found) > MOST_SHAPES:
        raise ValueError(f"more than {MOST_SHAPES} shapes of patterns")
    tokens = F.split(subject, r"\.", -1)
    keys = F.array_compact(F.array(*[_fits(F.col("_tokens"), s) for s in sorted(found or [""])]))
    asked = events.withColumn("_tokens", tokens).select(*events.columns, F.inline(keys))
    return asked.join(shaped, ["_shape", "_key"]).drop("_shape", "_key")
