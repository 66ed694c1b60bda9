"""Quality classifier: random Fourier features, ridge by normal equations, isotonic calibration.

Document statistics (character classes, word and line repetition, lengths) are
computed in one pass over each whole text. On a bounded sample of labelled rows
they are standardised and mapped to random Fourier features of a Gaussian
kernel; every partition sums its share of the normal equations and the driver
solves one system of D + 1 unknowns. Rows of the sample that the fit did not use
give the isotonic calibration, summed into a fixed number of bins first.

Defined cases: null and empty texts have all-zero statistics and get the score
of those; a null doc_id is not held out; without any labelled row the score is
0.5; with labels of one kind it is that label. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from . import _text as X
from ._fit import bounded_labels, fold, isotonic
from ._store import Scratch

N_STATS = 22
SUM_PARTITIONS = 8
BINS = 400

_LETTER = np.array([(65 <= b <= 90) or (97 <= b <= 122) or b >= 128 for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_STOP = np.isin(np.arange(256), list(b".,;:'\"?!-()"))
_OTHER = ~(_LETTER | _DIGIT | _SPACE | _STOP)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def statistics(text: bytes) -> list[float]:
    """The document statistics of one UTF-8 text."""
    if not text:
        return [0.0] * N_STATS
    h = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = len(text)
    letters = max(1, int(h[_LETTER].sum()))
    words = text.split()
    m = max(1, len(words))
    lowered = text.translate(_LOWER).split()
    distinct = set(lowered)
    lines = [x for x in text.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    share = h[h > 0] / n
    again = sum(map(bytes.__eq__, lowered, lowered[1:]))
    bare = sum(1 for w in distinct if not w[:-3].isalnum() and len(w) > 3)
    odd = h[_OTHER]
    half = len(lowered) // 2
    late = set(lowered[half:])
    return [
        math.log1p(n),
        math.log1p(len(words)),
        letters / n,
        h[_UPPER].sum() / letters,
        h[_DIGIT].sum() / n,
        h[_SPACE].sum() / n,
        h[_STOP].sum() / n,
        odd.sum() / n,
        math.log1p(int(odd.max())) - math.log1p(n),
        h[33] / m,  # exclamation marks a word
        h[124] / m,  # bars a word
        (h[35] + h[36] + h[37] + h[38] + h[42]) / m,  # # $ % & * a word
        float(-(share * np.log(share)).sum()),
        math.log(n / m),
        len(distinct) / m,
        math.log1p(m / max(1, len(distinct))),
        again / m,
        math.sqrt(again / m),
        len(set(lines)) / k,
        math.log1p(m / k),
        bare / max(1, len(distinct)),
        len(late) / max(1, len(lowered) - half),
    ]


def _stat_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in X.slices(batches, "text"):
        rows = np.array([statistics(t) for t in X.text_bytes(batch.column("text"))], float)
        stats = X.list_array(rows.ravel(), np.arange(len(rows) + 1) * N_STATS, pa.float64())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "y")), stats], names=["doc_id", "y", "stats"])


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, y, stats) of docs (doc_id, text, y)."""
    return docs.select("doc_id", "text", "y").mapInArrow(_stat_rows, "doc_id long, y int, stats array<double>")


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    knots: np.ndarray = field(default_factory=lambda: np.zeros(0))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    constant: float | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.omega + self.phase) * math.sqrt(2 / len(self.phase))
        return np.hstack([waves, np.ones((len(z), 1))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(stats), self.constant)
        # Row by row sums do not depend on how rows are batched.
        margin = np.einsum("ij,j->i", self.features(stats), self.weights)
        return np.clip(np.interp(margin, self.knots, self.values), 0, 1)


def _partial(build):
    """mapInArrow body that returns one row: the sum of build(stats, y) over the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                stats = np.array(batch.column("stats").to_pylist(), float)
                y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
                part = build(stats, y)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([X.list_array(total.ravel(), np.array([0, total.size]), pa.float64())], names=["total"])

    return run


def _summed(rows: DataFrame, build) -> np.ndarray | None:
    """Sum of the partitions' vectors; SUM_PARTITIONS rows reach the driver at most."""
    parts = rows.coalesce(SUM_PARTITIONS).mapInArrow(_partial(build), "total array<double>").collect()
    return np.sum([p.total for p in parts], axis=0) if parts else None


def fit_quality(
    docs: DataFrame, labels: DataFrame, bound: int = 20_000, features: int = 256, ridge: float = 1e-3, seed: int = 7
) -> QualityModel:
    """Fit on at most about `bound` labelled rows outside the held-out fold (crc32 mod 4 = 2)."""
    picked = bounded_labels(labels, "quality", 4, 2, bound)  # bounded, so the planner may broadcast it
    train = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")
    train = document_statistics(train).select("y", "stats", (F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(4)) == 0).alias("late"))
    scratch = Scratch(docs.sparkSession, "quality")
    train = scratch.save(train.repartition(SUM_PARTITIONS))
    try:
        early, late = train.where("not late"), train.where("late")
        moments = _summed(early, lambda s, y: np.concatenate([[len(s), y.sum()], s.sum(0), (s * s).sum(0)]))
        rng = np.random.default_rng(seed)
        n = 0 if moments is None else moments[0]
        mean = np.zeros(N_STATS) if not n else moments[2 : 2 + N_STATS] / n
        var = np.ones(N_STATS) if not n else moments[2 + N_STATS :] / n - mean**2
        model = QualityModel(
            mean,
            np.sqrt(np.maximum(var, 0)) + 1e-6,
            rng.normal(0, 1 / math.sqrt(N_STATS), (N_STATS, features)),
            rng.uniform(0, 2 * math.pi, features),
        )
        if not n or moments[1] in (0, n):
            model.constant = 0.5 if not n else float(moments[1] / n)
            return model
        d = features + 1

        def equations(s: np.ndarray, y: np.ndarray) -> np.ndarray:
            phi = model.features(s)
            return np.hstack([phi.T @ phi, (phi.T @ y)[:, None]])

        system = _summed(early, equations).reshape(d, d + 1)
        penalty = np.eye(d) * ridge * n / features
        penalty[-1, -1] = 0
        model.weights = np.linalg.solve(system[:, :d] + penalty + 1e-9 * np.eye(d), system[:, d])

        def binned(s: np.ndarray, y: np.ndarray) -> np.ndarray:
            at = np.clip(((model.features(s) @ model.weights + 0.5) * (BINS / 2)).astype(int), 0, BINS - 1)
            return np.stack([np.bincount(at, minlength=BINS), np.bincount(at, y, minlength=BINS)])

        bins = _summed(late, binned)
        bins = _summed(early, binned) if bins is None else bins
        count, good = bins.reshape(2, BINS)
        middle = (np.arange(BINS) + 0.5) / (BINS / 2) - 0.5
        # Half a row of each kind at the ends keeps scores off 0 and 1.
        x = np.concatenate([[middle[0]], middle, [middle[-1]]])
        w = np.concatenate([[0.5], count, [0.5]])
        y = np.concatenate([[0.0], good / np.maximum(count, 1), [1.0]])
        model.knots, model.values = isotonic(x, y, w)
        return model
    finally:
        scratch.drop(train)


def _score_rows(model: QualityModel, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "text"):
            score = model.score(np.array([statistics(t) for t in X.text_bytes(batch.column("text"))], float))
            kept = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=[*names, "score", "predicted"]
            )

    return run


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (doc_id, text)."""
    ship(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(_score_rows(model, threshold), "doc_id long, held_out boolean, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, bound: int = 20_000) -> DataFrame:
    """Fit on labels and score every document."""
    ship(docs.sparkSession)
    return score_quality(docs, fit_quality(docs, labels, bound))


def _keep_rows(model: QualityModel, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "text"):
            score = model.score(np.array([statistics(t) for t in X.text_bytes(batch.column("text"))], float))
            yield batch.filter(pa.array(score >= threshold))

    return run


def keep_good(docs: DataFrame, labels: DataFrame, bound: int = 20_000, threshold: float = 0.7) -> DataFrame:
    """The rows of docs, with all their columns, that are not rejected; no shuffle."""
    ship(docs.sparkSession)
    model = fit_quality(docs, labels, bound)
    return docs.mapInArrow(_keep_rows(model, threshold), docs.schema)
