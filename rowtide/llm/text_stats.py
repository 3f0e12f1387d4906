"""Counts and ratios of a text as column expressions.

One scan gives one narrow row of numbers per document; nothing later needs the
text. No Python runs here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rowtide.llm.common import SPACE, words_of

WINDOW = 8

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_distinct",
    "n_upper",
    "n_digits",
    "n_stops",
    "n_marks",
    "n_lines",
)


def _left(text: Column, pattern: str) -> Column:
    """Code points that stay when ``pattern`` is taken out."""
    return F.length(F.regexp_replace(text, pattern, ""))


def _pairs(hashes: str, step: int) -> Column:
    """Hash of each element with the one ``step`` places later."""
    n = F.greatest(F.size(hashes) - step, F.lit(0))
    head, tail = F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(1 + step), n)
    return F.zip_with(head, tail, lambda a, b: F.xxhash64(a, b))


def text_counts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and the counts of :data:`COUNTS`, all bigint.

    ``n_repeat_words`` counts the words inside windows of eight words that occur
    at least twice in the text, the first occurrence included; windows are
    compared by 64-bit hashes. Their array is sorted only for texts where two
    windows agree. A null text counts as empty: all zero. Any length of text
    takes time in proportion, but for the sort of repeated windows.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
        whole.alias("_t"),
        words_of(F.col(text)).alias("_w"),
        # All that is neither a lower-case ASCII letter nor beyond ASCII: a short rest for the other patterns.
        F.regexp_replace(whole, r"[a-z\x{80}-\x{10FFFF}]+", "").alias("_r"),
        F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"),
    )
    ids = [f"_k{i}" for i in range(len(keep))]
    counted = base.select(
        *ids,
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
        (F.length("_t") - _left(F.col("_r"), r"[^\x20\x09-\x0D]+")).alias("word_chars"),
        _left(F.col("_r"), r"[^#*$%&|<>]+").alias("n_symbols"),
        _left(F.col("_r"), r"[^A-Z]+").alias("n_upper"),
        _left(F.col("_r"), r"[^0-9]+").alias("n_digits"),
        _left(F.col("_r"), r"[^.]+").alias("n_stops"),
        _left(F.col("_r"), r"[^!?]+").alias("n_marks"),
        F.size("_l").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).alias("n_dup_lines"),
    )
    narrow = [c for c in counted.columns if c != "_h"]
    twos = counted.select(
        *narrow,
        F.size("_h").alias("n_words"),
        F.size(F.array_distinct("_h")).alias("n_distinct"),
        _pairs("_h", 1).alias("_p"),
    )
    narrow = [c for c in twos.columns if c != "_p"]
    fours = twos.select(*narrow, _pairs("_p", 2).alias("_p"))
    windows = fours.select(*narrow, _pairs("_p", 4).alias("_p"))
    agree = F.size(F.array_distinct("_p")) < F.size("_p")
    placed = windows.select(
        *narrow,
        F.when(
            agree,
            F.sort_array(F.transform("_p", lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
        ).alias("_s"),
    )
    n = F.size("_s") - 1
    ends = placed.select(
        *narrow,
        F.slice("_s", F.lit(1), n).alias("_a"),
        F.slice("_s", F.lit(2), n).alias("_b"),
    )
    # Neighbours in the sorted windows that agree: both places belong to a repeated window.
    both = F.flatten(
        F.zip_with(
            "_a",
            "_b",
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])).otherwise(F.array().cast("array<int>")),
        )
    )
    places = ends.select(*narrow, F.sort_array(F.array_distinct(both)).alias("_p"))
    gaps = F.zip_with("_p", F.slice("_p", F.lit(2), F.size("_p")), lambda a, b: F.coalesce(b - a, F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(0), lambda s, g: s + F.least(g, F.lit(WINDOW)))
    done = places.select(*narrow, F.coalesce(covered, F.lit(0)).alias("n_repeat_words"))
    return done.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        *[F.col(c).cast("bigint").alias(c) for c in COUNTS],
    )


def ratios() -> dict[str, Column]:
    """Features for the learned operators, from the counts; defined for empty texts."""
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    lines = F.greatest("n_lines", F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / n,
        "symbols": F.col("n_symbols") / chars,
        "symbols_a_word": F.col("n_symbols") / n,
        "dup_lines": F.col("n_dup_lines") / lines,
        "repeated": F.col("n_repeat_words") / n,
        "distinct": F.col("n_distinct") / n,
        "upper": F.col("n_upper") / chars,
        "digits": F.col("n_digits") / chars,
        "stops": F.col("n_stops") / n,
        "marks": F.col("n_marks") / n,
        "line_words": F.col("n_words") / lines,
    }


FEATURES = (
    "words",
    "word_length",
    "symbols",
    "symbols_a_word",
    "dup_lines",
    "repeated",
    "distinct",
    "upper",
    "digits",
    "stops",
    "marks",
    "line_words",
)
