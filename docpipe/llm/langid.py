"""Language identification with error-correcting output codes.

Each language gets a codeword of +1 and -1: all distinct splits of the languages
if there are at most six, else fixed pseudo-random columns. One binary classifier
a bit, the log ratio of hashed byte-trigram frequencies of the two sides, gives a
margin; decoding sums the logistic losses of the margins against each codeword,
weighted by how often that bit was right for that language in training, and the
nearest codeword wins. A small gap to the second marks the row as ambiguous.

Defined cases: null text and text without a letter are `und` with score 0; a null
doc_id is not held out; ties go to the language that sorts first; without any
training row all rows are `und`; with one language, that one. Other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from . import _text as X
from ._fit import fold
from ._store import Scratch

BUCKETS = 1 << 13
EVIDENCE = 40  # trigrams that count as independent evidence at most
SMOOTH = 0.5
SUM_PARTITIONS = 8
MOST_LANGUAGES = 1000  # more are no language column; an error, not a cut
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def trigram_counts(text: str) -> np.ndarray:
    """Hashed counts of byte trigrams of the letters of a text, lower-cased."""
    a = np.frombuffer(b" " + text.lower().encode().translate(_LETTERS) + b" ", np.uint8).astype(np.uint32)
    a = a[np.concatenate([[True], (a[1:] != 32) | (a[:-1] != 32)])]  # runs of blanks count once
    if len(a) < 3:
        return np.zeros(BUCKETS)
    h = a[:-2] * np.uint32(0x9E3779B1) ^ a[1:-1] * np.uint32(0x85EBCA6B) ^ a[2:] * np.uint32(0xC2B2AE35)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return np.bincount(h >> np.uint32(32 - 13), minlength=BUCKETS).astype(float)


def codewords(n: int, seed: int = 17) -> np.ndarray:
    """n rows of +1/-1; no column is constant and, where that is possible, no two columns are alike."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 6:
        columns = [[1 if i == 0 or (k >> (i - 1)) & 1 else -1 for i in range(n)] for k in range(2 ** (n - 1) - 1)]
        return np.array(columns, float).T
    rng = np.random.default_rng(seed)
    best, distance = None, -1
    for _ in range(100):
        m = rng.choice([-1.0, 1.0], (n, math.ceil(10 * math.log2(n))))
        m = m[:, np.abs(m.sum(0)) < n]
        least = min(int((m[i] != m[j]).sum()) for i in range(n) for j in range(i))
        if least > distance:
            best, distance = m, least
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # bits x BUCKETS
    trust: np.ndarray  # languages x bits; rows sum to 1

    def margins(self, text: str) -> np.ndarray:
        counts = trigram_counts(text)
        total = counts.sum()
        return self.weights @ counts / max(total, 1) * min(total, EVIDENCE)

    def decode(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return "und", 0.0, False
        loss = (self.trust * np.logaddexp(0, -self.code * self.margins(text))).sum(1) * self.code.shape[1] / 2
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        best = int(np.argmin(loss))
        second = float(np.sort(share)[-2]) if len(share) > 1 else 0.0
        return self.languages[best], float(share[best]), float(share[best]) - second < 0.2


def _sums(build):
    """mapInArrow body: (lang, total) with the partition's sum of build(text) for each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                part = build(lang, text)
                totals[lang] = totals[lang] + part if lang in totals else part
        if totals:
            rows = np.array(list(totals.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.string()), X.list_array(rows.ravel(), np.arange(len(rows) + 1) * rows.shape[1], pa.float64())],
                names=["lang", "total"],
            )

    return run


def _by_language(rows: DataFrame, build) -> dict[str, np.ndarray]:
    found: dict[str, np.ndarray] = {}
    for row in rows.mapInArrow(_sums(build), "lang string, total array<double>").collect():
        found[row.lang] = found.get(row.lang, 0) + np.array(row.total)
    return found


def fit_languages(docs: DataFrame, bound: int = 20_000) -> LanguageModel:
    """Fit on about `bound` documents at most, outside the held-out fold (crc32 mod 4 = 2)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), 4) != 2))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"lang has more than {MOST_LANGUAGES} values")
    if not sizes:
        return LanguageModel([], np.zeros((0, 1)), np.zeros((1, BUCKETS)), np.zeros((0, 1)))
    # The same share of the bound for each language, so that rare ones are learnt too.
    each, whole = bound // len(sizes), 1_000_000
    limit = F.lit(0)
    for lang, n in sizes.items():
        limit = F.when(F.col("lang") == lang, min(whole, whole * each // n)).otherwise(limit)
    picked = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(whole)) < limit).select("lang", "text")
    scratch = Scratch(docs.sparkSession, "language")
    picked = scratch.save(picked.repartition(SUM_PARTITIONS))
    try:
        counts = _by_language(picked, lambda lang, text: trigram_counts(text))
        languages = sorted(counts)
        if not languages:
            return LanguageModel([], np.zeros((0, 1)), np.zeros((1, BUCKETS)), np.zeros((0, 1)))
        code = codewords(len(languages))
        share = np.array([(counts[k] + SMOOTH) / (counts[k].sum() + SMOOTH * BUCKETS) for k in languages])
        side = lambda sign: np.array([share[c == sign].mean(0) if (c == sign).any() else share.mean(0) for c in code.T])
        model = LanguageModel(languages, code, np.log(side(1)) - np.log(side(-1)), np.full(code.shape, 1 / code.shape[1]))
        right = _by_language(
            picked, lambda lang, text: np.concatenate([[1.0], np.sign(model.margins(text)) == code[languages.index(lang)]])
        )
        accuracy = np.array([(right[k][1:] + 1) / (right[k][0] + 2) for k in languages])
        model.trust = accuracy / accuracy.sum(1, keepdims=True)
        return model
    finally:
        scratch.drop(picked)


def _language_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in X.slices(batches, "text"):
            found = [model.decode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.bool_()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    return run


def predict_languages(docs: DataFrame, model: LanguageModel | None = None, bound: int = 20_000) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row of docs."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model or fit_languages(docs, bound))  # languages x bits, bits x BUCKETS numbers
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(_language_rows(shared), "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")
