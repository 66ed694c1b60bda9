"""Centroid clustering with ball trees: exact rounds that touch few vectors where balls are clear.

Components become integers floor(scale * c). Each partition builds metric trees
over blocks of up to BLOCK vectors: a ball is split at the median of the
projection on two far members until it has LEAF vectors or radius 0, and stores
radius, count and the exact integer sum of its vectors; leaves hold the vectors.
The trees are a written table, so a round reads trees only.

A round walks the trees of its partition level by level with the centroids (a few
rows, sent with the task). By the triangle inequality a centroid i beats j in a
whole ball if d(ball, i) + radius < d(ball, j) - radius; floating-point distances
are widened by a bound on their error first. A ball with one centroid left adds
count and sum to it without a look at its vectors; others pass the centroids left
to their halves, and leaves compare exactly, in integers (ties: the smaller
number). A task returns counts and sums of the clusters; these are added up by
Spark, and the driver divides them (floor, exact).

Defined cases: rows whose vector is null, has null or non-finite entries, or not
`dim` components are left out; integers are held within +-2^27, so that squared
distances fit; a null id is never a starting centroid and is assigned like any
other; repeated rows count each; with fewer vectors than centroids each vector
begins one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship, spread
from ._store import Scratch
from .whitening import clean

SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
BLOCK = 4096  # vectors of one tree
LEAF = 32
LIMIT = 1 << 27
_SLACK = 1e-9  # relative widening of distances; their rounding error is below 1e-12

TREE = "radius array<double>, count array<long>, sum array<long>, child array<int>, start array<int>, ids array<long>, points array<long>"


@dataclass
class Tree:
    """Node i has vectors start[i]:start[i] + count[i] and halves child[i], child[i] + 1 (none: 0); node 0 is the root."""

    radius: np.ndarray
    count: np.ndarray
    sum: np.ndarray  # (nodes, dim)
    child: np.ndarray
    start: np.ndarray
    points: np.ndarray  # (vectors, dim), in the order of the leaves
    order: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # place in the block of each vector

    @property
    def centre(self) -> np.ndarray:
        return self.sum / self.count[:, None]


def build(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree of a block of integer vectors."""
    order = np.arange(len(points))
    spans = [(0, len(points))]
    radius, sums, child = [], [], []
    at = 0
    while at < len(spans):
        a, b = spans[at]
        x = points[order[a:b]]
        sums.append(x.sum(0))
        gap = x - sums[-1] / (b - a)
        away = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        same = (x == x[0]).all()
        radius.append(0.0 if same else float(away.max()) * (1 + _SLACK))
        child.append(0)
        if b - a > leaf and not same:
            one = x[away.argmax()]
            far = x[((x - one).astype(np.float64) ** 2).sum(1).argmax()]
            side = x.astype(np.float64) @ (far - one).astype(np.float64)
            cut = np.argsort(side, kind="stable")
            order[a:b] = order[a:b][cut]
            middle = a + (b - a) // 2
            child[at] = len(spans)
            spans += [(a, middle), (middle, b)]
        at += 1
    starts = np.array([a for a, _ in spans], np.int32)
    counts = np.array([b - a for a, b in spans], np.int64)
    return Tree(np.array(radius), counts, np.array(sums), np.array(child, np.int32), starts, points[order], order)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(vectors, centroids) exact squared distances, int64."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) < 1 << 21 and x.shape[1] <= 512:  # all sums stay under 2^53
        y, z = x.astype(np.float64), centroids.astype(np.float64)
        return ((y * y).sum(1)[:, None] - 2 * (y @ z.T) + (z * z).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)


def walk(tree: Tree, centroids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(balls, their centroid) that are clear, then (leaves, mask of centroids left) that are not: nodes by level."""
    centre, z = tree.centre, centroids.astype(np.float64)
    nodes = np.zeros(1, np.int64)
    left = np.ones((1, len(z)), bool)
    while len(nodes):
        gap = np.sqrt(((centre[nodes][:, None, :] - z) ** 2).sum(2))
        wide = tree.radius[nodes][:, None] + _SLACK * (gap + 1)
        reach = np.where(left, gap + wide, np.inf).min(1)
        left = left & (gap - wide <= reach[:, None])
        clear = left.sum(1) == 1
        yield nodes[clear], left[clear].argmax(1)
        halves = tree.child[nodes]
        leaf = ~clear & (halves == 0)
        yield nodes[leaf], left[leaf]
        deeper = ~clear & (halves > 0)
        nodes = (halves[deeper][:, None] + np.arange(2)).ravel().astype(np.int64)
        left = np.repeat(left[deeper], 2, axis=0)


def _members(tree: Tree, nodes: np.ndarray) -> np.ndarray:
    """Places of the vectors of some nodes, in their order."""
    counts = tree.count[nodes]
    return np.repeat(tree.start[nodes] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def nearest(tree: Tree, nodes: np.ndarray, left: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, cluster, squared distance) of the vectors of unclear leaves, among the centroids left to each."""
    at = _members(tree, nodes)
    gaps = squared(tree.points[at], centroids)
    gaps[~np.repeat(left, tree.count[nodes], axis=0)] = np.iinfo(np.int64).max
    cluster = gaps.argmin(1)
    return at, cluster, gaps[np.arange(len(at)), cluster]


def sums_of(tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Counts and sums of each cluster, and how many vectors were looked at."""
    k = len(centroids)
    counts, sums, seen = np.zeros(k, np.int64), np.zeros((k, centroids.shape[1]), np.int64), 0
    for nodes, found in walk(tree, centroids):
        if found.ndim == 1:
            np.add.at(counts, found, tree.count[nodes])
            np.add.at(sums, found, tree.sum[nodes])
        elif len(nodes):
            at, cluster, _ = nearest(tree, nodes, found, centroids)
            counts += np.bincount(cluster, minlength=k)
            np.add.at(sums, cluster, tree.points[at])
            seen += len(at)
    return counts, sums, seen


def labels_of(tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of every vector of a tree."""
    labels, gaps = np.zeros(len(tree.points), np.int64), np.zeros(len(tree.points), np.int64)
    for nodes, found in walk(tree, centroids):
        if found.ndim == 2:
            if len(nodes):
                at, cluster, gap = nearest(tree, nodes, found, centroids)
                labels[at], gaps[at] = cluster, gap
            continue
        at = _members(tree, nodes)
        labels[at] = np.repeat(found, tree.count[nodes])
        gap = tree.points[at] - centroids[labels[at]]
        gaps[at] = (gap * gap).sum(1)
    return labels, gaps


def _tree_rows(dim: int):
    names = [x.split()[0] for x in TREE.split(", ")]

    def rows(ids: list[pa.Array], blocks: list[np.ndarray]) -> pa.RecordBatch:
        tree = build(np.concatenate(blocks))
        held = pa.concat_arrays(ids).take(pa.array(tree.order))
        one = lambda v, kind: pa.ListArray.from_arrays(pa.array([0, v.size], pa.int32()), pa.array(v.ravel(), kind))
        arrays = [one(tree.radius, pa.float64()), one(tree.count, pa.int64()), one(tree.sum, pa.int64()), one(tree.child, pa.int32()), one(tree.start, pa.int32())]
        listed = pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held)
        return pa.RecordBatch.from_arrays([*arrays, listed, one(tree.points, pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        blocks: list[np.ndarray] = []
        held = 0
        for batch in batches:
            x = pc.list_flatten(batch.column("x")).to_numpy(zero_copy_only=False).reshape(-1, dim)
            for a in range(0, len(x), BLOCK):
                if held and held + min(BLOCK, len(x) - a) > BLOCK:
                    yield rows(ids, blocks)
                    ids, blocks, held = [], [], 0
                ids.append(batch.column("vec_id").slice(a, BLOCK))
                blocks.append(x[a : a + BLOCK])
                held += len(blocks[-1])
        if held:
            yield rows(ids, blocks)

    return run


def _trees(batches: Iterator[pa.RecordBatch], dim: int, ids: bool = False) -> Iterator[tuple[Tree, pa.Array | None]]:
    flat = lambda batch, name, i: batch.column(name)[i].values.to_numpy(zero_copy_only=False)
    for batch in batches:
        for i in range(batch.num_rows):
            parts = {n: flat(batch, n, i) for n in ("radius", "count", "sum", "child", "start", "points")}
            parts["sum"], parts["points"] = parts["sum"].reshape(-1, dim), parts["points"].reshape(-1, dim)
            yield Tree(**parts), batch.column("ids")[i].values if ids else None


def integer_vectors(embeddings: DataFrame, dim: int = 64, scale: int = SCALE, column: str = "embedding") -> DataFrame:
    """vec_id, x of the rows that are kept; JVM only."""
    whole = lambda e: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(F.greatest(F.lit(-1e15), F.least(F.lit(1e15), e * scale))))).cast("long")
    return clean(embeddings, column).where(F.size("v") == dim).select("vec_id", F.transform("v", whole).alias("x"))


def starting(rows: DataFrame, salt: str, k: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of `salt:vec_id`, in that order; equal ids by their components."""
    hashed = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(hashed.alias("h"), "x").where(F.col("h").isNotNull()).orderBy("h", "x").limit(k).collect()
    return np.array([r.x for r in first], np.int64)


def plant(rows: DataFrame, dim: int, scratch: Scratch) -> DataFrame:
    """The written table of trees, a row for each."""
    trees = rows.mapInArrow(_tree_rows(dim), TREE)
    return scratch.save(trees)


def round_sums(trees: DataFrame, centroids: np.ndarray) -> tuple[dict[int, int], dict[int, list[int]], int]:
    """Exact count and sums of each non-empty cluster, and the number of vectors that were looked at."""
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, seen = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64), 0
        for tree, _ in _trees(batches, dim):
            c, s, n = sums_of(tree, centroids)
            counts, sums, seen = counts + c, sums + s, seen + n
        full = np.flatnonzero(counts)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1) * dim, pa.int32()), pa.array(sums[full].ravel(), pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(counts[full]), lists, pa.array([seen] + [0] * (len(full) - 1) if len(full) else [], pa.int64())], names=["cluster", "n", "sums", "seen"])

    parts = trees.drop("ids").mapInArrow(run, "cluster int, n long, sums array<long>, seen long")
    each = parts.select("cluster", "n", "seen", F.posexplode("sums").alias("d", "s"))
    total = each.groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    counts = {r.cluster: r.n for r in total}
    sums = {c: [0] * dim for c in counts}
    for r in total:
        sums[r.cluster][r.d] = int(r.s)
    return counts, sums, sum(r.seen for r in total if r.d == 0)


def cluster(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, salt: str = "3", dim: int = 64, scale: int = SCALE, column: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance of every kept vector; the final centroids)."""
    spark = embeddings.sparkSession
    ship(spark)
    scratch = Scratch(spark, "balltree")
    rows = integer_vectors(embeddings, dim, scale, column)
    centroids = starting(rows, salt, k)
    if not len(centroids):
        # Vectors with null ids alone have no centroid to begin with.
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), []
    trees = plant(rows, dim, scratch)
    for _ in range(rounds):
        counts, sums, _ = round_sums(trees, centroids)
        new = centroids.copy()
        for c, n in counts.items():
            new[c] = [s // n for s in sums[c]]
        if (new == centroids).all():
            break  # a fixed point: further rounds change nothing
        centroids = new

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, ids in _trees(batches, dim, ids=True):
            labels, gaps = labels_of(tree, centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(labels, pa.int32()), pa.array(gaps)], names=["vec_id", "cluster", "distance"])

    out = scratch.save(trees.mapInArrow(run, "vec_id long, cluster int, distance long"))
    scratch.drop(trees)
    return out, centroids.tolist()


def cluster_digest(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, salt: str = "3", dim: int = 64) -> DataFrame:
    """One row per kept vector with its cluster, distance, inertias, and the digest of its centroid."""
    rows, centroids = cluster(spread(embeddings), k, rounds, salt, dim)
    spent = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    listed = lambda values, kind: F.get(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("cluster"))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return rows.select(
        "vec_id",
        "cluster",
        "distance",
        listed([spent.get(c) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(sum(spent.values())).cast("long").alias("inertia"),
        listed(digests, "string").alias("centroid_sha256"),
    )


def cluster_sql(k: int = CENTROIDS, rounds: int = ROUNDS, salt: str = "3", dim: int = 64, scale: int = SCALE) -> str:
    """The same in SQL: a table of (vector, dimension, integer), and two subqueries a round."""
    steps = [
        f"""r AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(CAST(e AS DOUBLE) * {scale}) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {dim} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)""",
        f"v AS MATERIALIZED (SELECT r, unnest(range({dim})) AS d, unnest(x) AS x FROM r)",
        f"s AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{salt}:' || vec_id), x) - 1 AS c, x FROM r WHERE vec_id IS NOT NULL ORDER BY c LIMIT {k})",
        f"c0 AS MATERIALIZED (SELECT c, unnest(range({dim})) AS d, unnest(x) AS x FROM s)",
    ]
    for i in range(rounds + 1):
        steps.append(f"g{i} AS MATERIALIZED (SELECT r, c, CAST(sum((v.x - k.x) * (v.x - k.x)) AS BIGINT) AS q FROM v JOIN c{i} k USING (d) GROUP BY r, c)")
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, arg_min(c, (q, c)) AS c, min(q) AS q FROM g{i} GROUP BY r)")
        if i < rounds:
            steps.append(f"m{i} AS (SELECT c, d, CAST(sum(x) AS HUGEINT) AS t, count(*) AS n FROM v JOIN a{i} USING (r) GROUP BY c, d)")
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c, d, CASE WHEN n IS NULL THEN o.x ELSE CAST((t - ((t % n) + n) % n) // n AS BIGINT) END AS x FROM c{i} o LEFT JOIN m{i} USING (c, d))")
    return f"""WITH {', '.join(steps)}
SELECT r.vec_id, CAST(a.c AS INTEGER) AS cluster, a.q AS distance, CAST(sum(a.q) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.q) OVER () AS BIGINT) AS inertia, h.sha AS centroid_sha256
FROM r JOIN a{rounds} a USING (r) JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS sha FROM c{rounds} GROUP BY c) h USING (c)"""


CLUSTER_SQL = cluster_sql()
