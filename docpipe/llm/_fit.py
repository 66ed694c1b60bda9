"""Training rows, isotonic calibration and small solvers shared by the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(parts)


def bounded_labels(labels: DataFrame, label: str, parts: int, held: int, bound: int) -> DataFrame:
    """(doc_id, y) of rows outside the held-out fold, about `bound` of them at most.

    Rows with a null id or label are left out; an id with several labels counts
    as 1 if any of them is. Above the bound, the ids whose hash falls under a
    share of the hash range are used, so the choice needs no sort and repeats.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    rows = rows.where(F.col("y").isNotNull() & (fold(F.col("doc_id"), parts) != held))
    count = rows.count()
    if count > bound:
        share = 1_000_000
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(share)) < int(share * bound / count))
    return rows.groupBy("doc_id").agg(F.max("y").alias("y"))


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators over points sorted by x: knots and increasing values."""
    blocks: list[list[float]] = []  # value, weight, weighted x
    for xi, yi, wi in zip(x, y, weight):
        if wi <= 0:
            continue
        blocks.append([float(yi), float(wi), float(xi * wi)])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, s = blocks.pop()
            u = blocks[-1]
            u[0] = (u[0] * u[1] + v * w) / (u[1] + w)
            u[1] += w
            u[2] += s
    return np.array([s / w for _, w, s in blocks]), np.array([v for v, _, _ in blocks])
