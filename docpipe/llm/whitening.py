"""Embedding whitening from an exact scatter matrix in residue numbers.

Components become integers x = floor(scale * c) + offset. One pass adds up the
count n and the sums S of every dimension, exactly. The centred integers
y = n * x - S have a scatter of up to n * max(y)^2, far beyond 2^53, so a second
pass works modulo several primes under 2^20: y mod p is formed from n, x and S
mod p, a partition multiplies blocks of BLOCK rows as double matrices (every sum
of products stays under 2^53, so it is exact) and keeps residues only. Residues of
partitions are added modulo p in two steps, and Chinese remaindering gives the
exact scatter, which is n^3 times the covariance; as many primes are taken as twice
its bound needs. The covariance is rounded once, to double, and decomposed by eigh.

Components are unit eigenvectors by falling eigenvalue, with the sign that makes
the entry of largest magnitude positive (the first of equal ones). A component
whose eigenvalue is within rounding of zero (1e-13 of the trace, or less) has no
scale: its whitened values are null and it is no part of identity_error.

Defined cases: rows whose vector is null or has null or non-finite entries are
left out; so are vectors of other lengths than the most frequent one (of equally
frequent ones the longest), and empty vectors; x is held within +-2^62; a null id is
kept; repeated rows count each; other columns are ignored; an empty table gives
no rows. A deviation above the range of long is null; deviation_exact has it in
full as text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
BLOCK = 4096  # rows of one modular product: BLOCK * 2^40 < 2^53
MERGERS = 8  # tasks that add up the residues of all partitions
_LIMIT = float(1 << 62)
_CUT = 1e-13  # of the trace


def primes_below(top: int) -> Iterator[int]:
    """Primes under top, falling, by trial division."""
    for p in range(top - 1, 2, -1):
        if p % 2 and all(p % q for q in range(3, int(p**0.5) + 1, 2)):
            yield p


def moduli(bound: int) -> list[int]:
    """As many primes under 2^20 as make a product above 2 * bound."""
    found: list[int] = []
    for p in primes_below(1 << 20):
        found.append(p)
        if prod(found) > 2 * bound:
            return found
    raise ValueError("the bound is too large")


def combine(residues: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Chinese remaindering: integers in (-M / 2, M / 2] of given residues, as an object array."""
    whole = prod(primes)
    total = sum(r.astype(object) * (whole // p * pow(whole // p, -1, p)) for r, p in zip(residues, primes)) % whole
    return np.where(total > whole // 2, total - whole, total)


def integers(vectors: pa.Array, dim: int, scale: int, offset: int) -> np.ndarray:
    """(rows, dim) int64 of clean vectors of one length."""
    flat = pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return np.clip(np.floor(flat * scale), -_LIMIT, _LIMIT).astype(np.int64) + offset


def clean(embeddings: DataFrame, column: str) -> DataFrame:
    """vec_id, v of the rows without null or non-finite entries; decided in the JVM."""
    v = F.col(column).cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    v = F.col("v")
    return rows.where(v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) != float("inf")), F.lit(False))))


@dataclass(frozen=True)
class Moments:
    """n, exact sums, and the largest |x| of the fit list."""

    dim: int
    n: int
    sums: tuple[int, ...]
    largest: int


def _moment_rows(scale: int, offset: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            v = batch.column("v")
            sizes = pc.list_value_length(v).to_numpy(zero_copy_only=False)
            for dim in set(sizes.tolist()):
                x = integers(v.filter(pa.array(sizes == dim)), dim, scale, offset)
                high, low = x >> 31, x & ((1 << 31) - 1)  # two halves: no batch overflows
                sums = high.sum(0).astype(object) * (1 << 31) + low.sum(0).astype(object)
                at = held.setdefault(dim, [0, np.zeros(dim, object), 0])
                at[0] += len(x)
                at[1] = at[1] + sums
                at[2] = max(at[2], int(x.max()), -int(x.min()))
        for dim, (n, sums, largest) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), pa.array([str(s) for s in sums]), pa.array([largest] * dim, pa.int64())],
                names=["dim", "d", "n", "s", "largest"],
            )

    return run


def moments(rows: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> Moments | None:
    """Exact moments of the most frequent length; a row per dimension reaches the driver."""
    parts = rows.select("v").mapInArrow(_moment_rows(scale, offset), "dim int, d int, n long, s string, largest long")
    sums = parts.groupBy("dim", "d").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.max("largest").alias("largest"))
    lengths = sums.groupBy("dim").agg(F.max("n").alias("n"), F.max("largest").alias("largest"), F.array_sort(F.collect_list(F.struct("d", "s"))).alias("sums"))
    best = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    return best and Moments(best.dim, best.n, tuple(int(r.s) for r in best.sums), best.largest)


def merged(parts: DataFrame, add: Callable[[list, list], list], kinds: str) -> dict[int, list]:
    """Rows (k, values) of many partitions added up by k, in MERGERS tasks and then on the driver; rows are matrices, not data."""

    def total(rows) -> dict[int, list]:
        held: dict[int, list] = {}
        for k, *values in rows:
            held[k] = add(held[k], values) if k in held else values
        return held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []

        def rows():
            for batch in batches:
                names[:] = batch.schema.names
                yield from zip(*(c.to_pylist() for c in batch.columns))

        for k, values in total(rows()).items():
            yield pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, [k, *values])})

    return total(tuple(r) for r in parts.repartition(MERGERS).mapInArrow(run, kinds).collect())


def scatter(rows: DataFrame, m: Moments, scale: int = SCALE, offset: int = OFFSET) -> np.ndarray:
    """The exact sum of y y^T over the fit list, y = n * x - S, as an object array."""
    largest = m.n * m.largest + max(map(abs, m.sums))
    primes = moduli(m.n * largest * largest)
    shifts = [np.array([s % p for s in m.sums], np.int64) for p in primes]
    dim, n = m.dim, m.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((dim, dim), np.int64) for _ in primes]
        for batch in batches:
            x = integers(batch.column("v"), dim, scale, offset)
            for a in range(0, len(x), BLOCK):
                block = x[a : a + BLOCK]
                for k, p in enumerate(primes):
                    y = ((n % p * (block % p) - shifts[k]) % p).astype(np.float64)
                    total[k] = (total[k] + (y.T @ y).astype(np.int64)) % p
        yield pa.RecordBatch.from_pydict({"prime": primes, "residues": [t.tobytes() for t in total]}, schema=pa.schema([("prime", pa.int64()), ("residues", pa.binary())]))

    def add(a: list, b: list) -> list:
        return [(np.frombuffer(a[0], np.int64) + np.frombuffer(b[0], np.int64)).tobytes()]  # under 2^20 each, so sums of 2^43 partitions fit

    kinds = "prime long, residues binary"
    found = merged(rows.select("v").where(F.size("v") == dim).mapInArrow(run, kinds), add, kinds)
    return combine([np.frombuffer(found[p][0], np.int64).reshape(dim, dim) for p in primes], primes)


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: whitened = ((n * x - S) / n) @ axes / sqrt(eigenvalues)."""

    moments: Moments
    eigenvalues: np.ndarray  # all, falling
    axes: np.ndarray  # (dim, components), unit columns
    trace: float
    scale: int
    offset: int

    @property
    def kept(self) -> np.ndarray:
        """Which of the components have a scale."""
        return self.eigenvalues[: self.axes.shape[1]] > _CUT * self.trace

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: int64 where it fits, else Python integers."""
        m = self.moments
        if m.n * m.largest + max(map(abs, m.sums)) < 1 << 62:
            return m.n * x - np.array(m.sums, np.int64)
        return m.n * x.astype(object) - np.array(m.sums, object)

    def apply(self, y: np.ndarray) -> np.ndarray:
        """Whitened rows of centred integers; nan where a component has no scale."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.kept, 1 / np.sqrt(self.eigenvalues[: self.axes.shape[1]]), np.nan)
        return (y / self.moments.n).astype(np.float64) @ self.axes * scale


def fit_whitening(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET, column: str = "embedding") -> Whitening | None:
    """Fit on all clean vectors; None if there are none."""
    ship(embeddings.sparkSession)
    rows = clean(embeddings, column)
    m = moments(rows, scale, offset)
    if m is None:
        return None
    exact = scatter(rows, m, scale, offset)
    cube = m.n**3
    covariance = np.array([[int(v) / cube for v in row] for row in exact])
    trace = sum(int(exact[i, i]) for i in range(m.dim)) / cube
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1][:, :components]
    top = np.abs(vectors).argmax(0)
    return Whitening(m, np.maximum(values, 0), vectors * np.where(vectors[top, np.arange(vectors.shape[1])] < 0, -1, 1), trace, scale, offset)


def identity_error(rows: DataFrame, w: Whitening) -> float | None:
    """Largest entry of |covariance of the whitened vectors - identity|, measured on all of them, centred before multiplying."""
    keep = np.flatnonzero(w.kept)
    k, dim = len(keep), w.moments.dim
    if not k:
        return None

    def pack(n: int, mean: np.ndarray, square: np.ndarray) -> list:
        return [n, mean.tobytes(), square.tobytes()]

    def add(a: list, b: list) -> list:
        n, m, p = a[0] + b[0], np.frombuffer(a[1]), np.frombuffer(b[1])
        gap = p - m
        square = np.frombuffer(a[2]) + np.frombuffer(b[2]) + np.outer(gap, gap).ravel() * (a[0] * b[0] / n)
        return pack(n, m + gap * (b[0] / n), square)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            z = w.apply(w.centred(integers(batch.column("v"), dim, w.scale, w.offset)))[:, keep]
            if len(z):
                mean = z.mean(0)
                part = pack(len(z), mean, (z - mean).T @ (z - mean))
                total = part if total is None else add(total, part)
        if total is not None:
            yield pa.RecordBatch.from_pydict({n: [v] for n, v in zip(("k", "n", "mean", "square"), [0, *total])})

    kinds = "k long, n long, mean binary, square binary"
    n, _, square = merged(rows.select("v").where(F.size("v") == dim).mapInArrow(run, kinds), add, kinds)[0]
    return float(np.abs(np.frombuffer(square).reshape(k, k) / n - np.eye(k)).max())


def whitened_vectors(embeddings: DataFrame, w: Whitening, column: str = "embedding") -> DataFrame:
    """vec_id, deviation_exact (text), whitened array<double> of every clean vector of the fitted length. Map-only."""
    ship(embeddings.sparkSession)
    dim = w.moments.dim
    small = dim * (w.moments.n * w.moments.largest + max(map(abs, w.moments.sums))) ** 2 < 1 << 63

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = w.centred(integers(batch.column("v"), dim, w.scale, w.offset))
            z = w.apply(y)
            wide = y if small else y.astype(object)
            k = z.shape[1]
            flat = pa.array(z.ravel(), pa.float64(), mask=np.isnan(z.ravel()))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * k, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([str(d) for d in (wide * wide).sum(1).tolist()], pa.string()), lists], names=["vec_id", "deviation_exact", "whitened"])

    rows = clean(embeddings, column).where(F.size("v") == dim)
    return rows.mapInArrow(run, "vec_id long, deviation_exact string, whitened array<double>")


def whitening(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET, column: str = "embedding") -> DataFrame:
    """One row per clean vector and component, with what was measured on the fit list."""
    w = fit_whitening(embeddings, components, scale, offset, column)
    kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact string"
    if w is None:
        return embeddings.sparkSession.createDataFrame([], kinds)
    error = identity_error(clean(embeddings, column), w)
    share = [float(e / w.trace) if w.trace > 0 else None for e in w.eigenvalues[: w.axes.shape[1]]]
    rows = whitened_vectors(embeddings, w, column).select("vec_id", "deviation_exact", F.posexplode("whitened").alias("i", "whitened"))
    shares = F.array(*(F.lit(s).cast("double") for s in share))
    return rows.select(
        "vec_id",
        (F.col("i") + 1).alias("component"),
        F.lit(w.moments.n).cast("long").alias("n"),
        F.expr("try_cast(deviation_exact AS bigint)").alias("deviation"),
        "whitened",
        F.get(shares, F.col("i")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
        "deviation_exact",
    )
