"""Token counts of a unigram vocabulary without making the tokens.

An Aho-Corasick automaton lists every vocabulary piece in a word; dynamic
programming over the end positions carries the best score and the number of
pieces on its path. Ties follow the tokenizer: of equal scores the path whose
last piece starts first wins, and a character that is no piece costs ten more
than the worst piece and falls back to its bytes.

No piece holds a space mark after another character, so every path passes each
start of a word, and words can be counted one by one; each task remembers
counts of words up to a bound. Vocabularies for which that does not hold are
counted text by text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowtide.session import ship

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE = 400_000
Vocabulary = Sequence[tuple[str, float]]


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Viterbi(dict):
    """Piece count by chunk of text; unseen chunks are computed, and forgotten beyond a bound."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        known = {p for p, _ in vocabulary}
        self.bytes_known = all(f"<0x{b:02X}>" in known for b in range(256))
        self.by_word = self.bytes_known and not any(re.search(f"[^{MARK}]{MARK}", p) for p in known)

    def __missing__(self, chunk: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        out = self[chunk] = self.count(chunk.replace(" ", MARK))
        return out

    def count(self, text: str) -> int:
        """Pieces on the best path through ``text``, spaces already marked."""
        n = len(text)
        score: list[float | None] = [None] * (n + 1)
        pieces = [0] * (n + 1)
        fused = [False] * (n + 1)  # the path ends with an unknown character
        score[0] = 0.0
        matches = iter(self.automaton.iter(text)) if len(self.automaton) else iter(())
        last, found = next(matches, (n, None))
        for end in range(1, n + 1):
            best, count, single = None, 0, False
            while found is not None and last == end - 1:
                length, value = found
                start = end - length
                single |= length == 1
                now = score[start] + value
                if best is None or now > best:  # longest first: the earliest start keeps a tie
                    best, count = now, pieces[start] + 1
                last, found = next(matches, (n, None))
            if not single:
                now = score[end - 1] + self.unknown
                if best is None or now > best:
                    best = now
                    if self.bytes_known:
                        count = pieces[end - 1] + len(text[end - 1].encode("utf-8", "replace"))
                    else:
                        count = pieces[end - 1] + (not fused[end - 1])
                    fused[end] = True
            score[end], pieces[end] = best, count
        return pieces[n]

    def text(self, text: str) -> int:
        """Tokens of a text that starts with a space mark."""
        if not text:
            return 0
        if MARK in text:  # a mark in the text is the same to the tokenizer as a space
            text = text.replace(MARK, " ")
        if not self.by_word:
            return self.count(MARK + text.replace(" ", MARK))
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return sum(map(self.__getitem__, [" " + w for w in text.split(" ")]))
        return sum(map(self.__getitem__, re.findall(" +[^ ]*", " " + text)))


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, and ``n_tokens`` (bigint).

    ``vocabulary`` is the path of a model file on the driver.
    The pieces travel to the tasks with the function; their number is that of
    the file. Null and empty texts have no tokens; texts are counted whole, in
    memory of their own length. The other columns, of any name but
    ``n_tokens``, pass through.
    """
    ship(docs.sparkSession)
    pieces = read_vocabulary(vocabulary)
    rest = [c for c in docs.columns if c not in ("n_tokens", text)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Viterbi(pieces)
        for b in batches:
            found = [model.text(t or "") for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(found, pa.int64())], ["_row", "_n"])

    packed = docs.select(F.struct(*rest).alias("_row"), F.col(text).alias("_text"))
    kind = packed.schema["_row"].dataType.simpleString()
    return packed.mapInArrow(count, f"_row {kind}, _n bigint").select("_row.*", F.col("_n").alias("n_tokens"))
