"""Toxicity: a linear classifier with a counterfactual penalty on identity terms.

Words that differ most between toxic and other labelled documents (chi-square)
and all identity terms are the features. For every labelled sentence with an
identity term, a counterfactual is made by swapping the term for another of its
group; the squared change of the document's logit under the swap is penalised, so
the weight of a mention goes to what its group has in common and neutral mentions
are not punished. Each Newton step of the logistic fit sums the partitions' shares
of the gradient and Hessian, and the driver solves one small system. Rows the fit did
not use calibrate scores by isotonic regression.

Defined cases: null and empty texts have no features and get that score; a null
doc_id is not held out; without labels the score is 0.5, with one kind of label
that label; other columns are ignored.
"""

from __future__ import annotations

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

SUM_PARTITIONS = 8
BINS = 400
REACH = 10.0  # margins beyond are calibrated as this one
NEWTON_STEPS = 10
FEATURES = 400  # selected words; identity terms come on top
LEAST_CHI = 25.0
LEAST_DOCS = 3
STEMS = (4, 5)

# Groups of identity terms that are swapped for each other.
IDENTITY_GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("african", "american", "european", "chinese", "indian", "mexican", "arab"),
    ("immigrant", "native", "refugee"),
    ("immigrants", "natives", "refugees"),
    ("old", "young"),
    ("deaf", "blind", "disabled"),
)


def swaps(groups=IDENTITY_GROUPS) -> dict[bytes, bytes]:
    """term -> the next term of its group."""
    return {a.encode(): b.encode() for g in groups for a, b in zip(g, (*g[1:], g[0]))}


def words_of(text: bytes) -> set[bytes]:
    return set(text.translate(X.ALNUM_FOLD).split())


def features_of(words: set[bytes]) -> set[bytes]:
    """The words, and their stems as first bytes (inflected languages) marked with a star."""
    return words.union(*({w[:k] + b"*" for w in words if len(w) > k} for k in STEMS))


def swapped_words(text: bytes, terms: dict[bytes, bytes]) -> set[bytes]:
    """The words after the identity terms of each sentence are swapped."""
    out: set[bytes] = set()
    for sentence in text.replace(b"!", b".").replace(b"?", b".").replace(b"\n", b".").split(b"."):
        out.update(terms.get(w, w) for w in words_of(sentence))
    return out


def bin_of(margin: float) -> int:
    return min(BINS - 1, max(0, int((margin + REACH) / (2 * REACH) * BINS)))


@dataclass
class ToxicityModel:
    index: dict[bytes, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    knots: np.ndarray = field(default_factory=lambda: np.zeros(0))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    constant: float | None = None

    def margin(self, words: set[bytes]) -> float:
        found = sorted(self.index[w] for w in self.index.keys() & words)
        return float(self.weights[found].sum() + self.weights[-1])

    def score(self, text: bytes) -> float:
        if self.constant is not None:
            return self.constant
        return float(np.clip(np.interp(self.margin(features_of(words_of(text))), self.knots, self.values), 0, 1))


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in X.slices(batches, "text"):
        found = [[w.decode("latin-1") for w in features_of(words_of(t))] for t in X.text_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.list_(pa.string()))], names=["y", "words"])


def _coded_rows(index: dict[bytes, int], terms: dict[bytes, bytes]):
    """Feature numbers of each text and, if it has identity terms, of its counterfactual; the last number is the constant."""

    def code(words: set[bytes]) -> list[int]:
        return [*sorted(index[w] for w in index.keys() & features_of(words)), len(index)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "text"):
            at, other = [], []
            for text in X.text_bytes(batch.column("text")):
                words = words_of(text)
                at.append(code(words))
                other.append(code(swapped_words(text, terms)) if terms.keys() & words else None)
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), batch.column("late"), pa.array(at, ints), pa.array(other, ints)], names=["y", "late", "at", "other"]
            )

    return run


def _sum_rows(build):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for y, at, other in zip(*(batch.column(c).to_pylist() for c in ("y", "at", "other"))):
                total = build(total, y, at, other)
        if total is not None:
            yield pa.RecordBatch.from_arrays([X.list_array(total.ravel(), np.array([0, total.size]), pa.float64())], names=["total"])

    return run


def _summed(rows: DataFrame, build) -> np.ndarray | None:
    parts = rows.coalesce(SUM_PARTITIONS).mapInArrow(_sum_rows(build), "total array<double>").collect()
    return np.sum([p.total for p in parts], axis=0) if parts else None


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, bound: int = 12_000, ridge: float = 1.0, penalty: float = 10.0, groups=IDENTITY_GROUPS
) -> ToxicityModel:
    """Fit on at most about `bound` labelled rows outside the held-out fold (crc32 mod 5 = 0)."""
    picked = bounded_labels(labels, "toxic", 5, 0, bound)
    train = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    train = train.join(F.broadcast(picked), "doc_id")
    train = train.select("y", "text", (F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(4)) == 0).alias("late"))
    scratch = Scratch(docs.sparkSession, "toxicity")
    train = scratch.save(train.repartition(SUM_PARTITIONS))
    try:
        early, late = train.where("not late"), train.where("late")
        sizes = {r["y"]: r["count"] for r in early.groupBy("y").count().collect()}
        n, bad = sum(sizes.values()), sizes.get(1, 0)
        if bad in (0, n):
            return ToxicityModel(constant=0.5 if not n else float(bad > 0))
        words = early.select("y", "text").mapInArrow(_word_rows, "y int, words array<string>")
        seen = words.select("y", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("docs"), F.sum("y").alias("bad"))
        expected = F.col("docs") * F.lit(bad / n)
        chi = (F.col("bad") - expected) ** 2 / expected + (F.col("bad") - expected) ** 2 / (F.col("docs") - expected)
        best = seen.where(F.col("docs") >= LEAST_DOCS).withColumn("chi", chi).where(F.col("chi") >= LEAST_CHI)
        chosen = [r.word.encode("latin-1") for r in best.orderBy(F.desc("chi"), "word").limit(FEATURES).collect()]
        terms = swaps(groups)
        model = ToxicityModel({w: i for i, w in enumerate(dict.fromkeys([*chosen, *terms]))})
        d = len(model.index) + 1
        coded = scratch.save(
            train.select("y", "late", "text").mapInArrow(_coded_rows(model.index, terms), "y int, late boolean, at array<int>, other array<int>")
        )
        early, late = coded.where("not late"), coded.where("late")
        model.weights = np.zeros(d)
        model.weights[-1] = np.log(bad / (n - bad))
        for _ in range(NEWTON_STEPS):
            current = model.weights

            def equations(total, y: int, at: list[int], other: list[int] | None, current=current):
                """Gradient and Hessian of the log loss and of the counterfactual penalty."""
                if total is None:
                    total = np.zeros((d, d + 1))
                margin = current[at].sum()
                p = 1 / (1 + np.exp(-margin))
                total[np.ix_(at, at)] += p * (1 - p)
                total[at, d] += p - y
                if other is not None:
                    gone, new = [i for i in at if i not in other], [i for i in other if i not in at]
                    change = np.concatenate([np.ones(len(gone)), -np.ones(len(new))])
                    both = [*gone, *new]
                    total[np.ix_(both, both)] += penalty * np.outer(change, change)
                    total[both, d] += penalty * change * (margin - current[other].sum())
                return total

            system = _summed(early, equations).reshape(d, d + 1)
            regular = np.eye(d) * ridge
            regular[-1, -1] = 1e-6
            move = np.linalg.solve(system[:, :d] + regular, system[:, d] + np.diag(regular) * current)
            model.weights = current - move
            if np.abs(move).max() < 1e-3:
                break

        def binned(total, y: int, at: list[int], other: list[int] | None):
            if total is None:
                total = np.zeros((2, BINS))
            place = bin_of(model.weights[at].sum())
            total[0, place] += 1
            total[1, place] += y
            return total

        bins = _summed(late, binned)
        bins = _summed(early, binned) if bins is None else bins
        count, toxic = bins.reshape(2, BINS)
        middle = (np.arange(BINS) + 0.5) / BINS * 2 * REACH - REACH
        x = np.concatenate([[middle[0]], middle, [middle[-1]]])
        w = np.concatenate([[0.5], count, [0.5]])
        y = np.concatenate([[0.0], toxic / np.maximum(count, 1), [1.0]])
        model.knots, model.values = isotonic(x, y, w)
        return model
    finally:
        scratch.clear()


def _score_rows(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in X.slices(batches, "text"):
            score = np.array([model.score(t) for t in X.text_bytes(batch.column("text"))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return run


def toxicity(docs: DataFrame, labels: DataFrame, bound: int = 12_000, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(fit_toxicity(docs, labels, bound))  # FEATURES + identity terms at most
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(_score_rows(shared, threshold), "doc_id long, held_out boolean, score double, predicted int")
