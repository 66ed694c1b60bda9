"""Token counts by a count-only Viterbi pass over a unigram vocabulary.

The vocabulary is the piece table of an installed public model file. That file
gives an order of pieces and no probabilities, so piece i gets the Zipf score
-ln(i + 1); `vocabulary` takes other scores as well. An Aho-Corasick automaton
enumerates all pieces that end at each character; dynamic programming carries the
best score and the piece count of that path, and never builds the pieces.

Rules are those of the tokenizers library's Unigram model with Metaspace
splitting: blanks become U+2581, one is put in front if the text does not begin
with one, and each part that begins with it is segmented by itself; of equal
scores the piece that begins earlier wins; a character without a piece of its own
costs the least score minus 10 and counts as its UTF-8 bytes (byte fallback).

Defined cases: null and empty texts have no tokens and score 0; a null doc_id is
kept; repeated rows count alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from . import _text as X

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 500_000


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) in id order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), -float(np.log(i + 1))) for i in range(model.get_piece_size())]


class Counter:
    """Counts of whole texts; parts that repeat are looked up in a table that is emptied when full."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[int, float]] = {}

    def part(self, part: str) -> tuple[int, float]:
        """(pieces, best score) of one part."""
        n = len(part)
        best = [None] * n + [0.0]  # best[-1] is the beginning
        count = [0] * (n + 1)
        done = 0
        single = False

        def unknown(i: int) -> None:
            score = best[i - 1] + self.unknown
            if best[i] is None or score > best[i]:
                best[i] = score
                count[i] = count[i - 1] + len(part[i].encode())

        # Matches come by end, the longest first, so a later one must be better to win.
        for end, (size, score) in self.automaton.iter(part):
            if end > done:
                if not single:
                    unknown(done)
                for i in range(done + 1, end):
                    unknown(i)
                done, single = end, False
            score += best[end - size]
            if size == 1:
                single = True
            if best[end] is None or score > best[end]:
                best[end] = score
                count[end] = count[end - size] + 1
        if not single:
            unknown(done)
        for i in range(done + 1, n):
            unknown(i)
        return count[n - 1], best[n - 1]

    def count(self, text: str | None) -> tuple[int, int, float]:
        """(parts, pieces, score) of a text."""
        if not text:
            return 0, 0, 0.0
        text = text.replace(" ", SPACE)
        parts = (text if text.startswith(SPACE) else SPACE + text).split(SPACE)[1:]
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for p in set(parts).difference(known):
            known[p] = self.part(SPACE + p)
        found = [known[p] for p in parts]
        return len(parts), sum(f[0] for f in found), sum(f[1] for f in found)


_counters: dict[str, Counter] = X.cache("tokencount")


def _count_rows(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "text", keeps="tokencount"):
            if path not in _counters:
                _counters[path] = Counter(vocabulary(path))
            found = [_counters[path].count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.float64()),
                ],
                names=["doc_id", "n_parts", "n_tokens", "score"],
            )

    return run


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_parts, n_tokens, score for every row of docs (doc_id, text)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_count_rows(model_path), "doc_id long, n_parts long, n_tokens long, score double")
