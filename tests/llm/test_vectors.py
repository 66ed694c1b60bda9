"""Whitening and clustering against plain versions in Python integers and double arithmetic."""

from __future__ import annotations

import hashlib
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from docpipe.llm import balltree, queries, whitening

from .helpers import with_clashes

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return with_clashes(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).repartition(5)


def odd(dim):
    """Rows that are left out, a null id, copies of one vector."""
    good = [0.25] * dim
    return [(900, None), (901, []), (902, [None] + good[1:]), (903, [math.nan] + good[1:]), (904, [math.inf] + good[1:]), (905, good + [1.0]), (None, good), (906, good), (906, good), (907, good)]


def made(n, dim, seed=1, groups=5):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 1, (groups, dim))
    return [(i, [float(np.float32(x)) for x in middle[i % groups] + rng.normal(0, 0.05, dim)]) for i in range(n)]


def test_remainders():
    primes = whitening.moduli(10**40)
    assert math.prod(primes) > 2 * 10**40 and len(set(primes)) == len(primes)
    assert all(p < 1 << 20 and all(p % q for q in range(2, 1100) if q < p) for p in primes)
    values = np.array([0, 1, -1, 10**40, -(10**40), 123456789012345678901234567890], object)
    got = whitening.combine([np.array([int(v % p) for v in values], np.int64) for p in primes], primes)
    assert got.tolist() == values.tolist()


def exact_scatter(x):
    n, dim = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(dim)]
    y = [[n * r[j] - s[j] for j in range(dim)] for r in x]
    return n, s, y, [[sum(r[i] * r[j] for r in y) for j in range(dim)] for i in range(dim)]


@pytest.mark.parametrize("wide", [1, 10**15])
def test_scatter_is_exact(spark, wide):
    """Also where x has 60 bits, far from what double can multiply."""
    rows = [(i, [v * wide for v in e]) for i, e in made(60, 5)]
    df = whitening.clean(vectors(spark, rows + odd(5)), "embedding")
    m = whitening.moments(df)
    x = [[max(-(2**62), min(2**62, math.floor(np.float64(np.float32(v)) * 64))) + 1_000_000 for v in e] for _, e in rows + [r for r in odd(5) if r[0] in (None, 906, 907)]]
    n, s, _, want = exact_scatter(x)
    assert (m.n, list(m.sums), m.largest) == (n, s, max(abs(v) for r in x for v in r))
    assert whitening.scatter(df, m).tolist() == want


@pytest.mark.parametrize("dim,count", [(6, 200), (40, 300)])
def test_whitening(spark, dim, count):
    rows = made(count, dim, groups=60)
    got = whitening.whitening(vectors(spark, rows + odd(dim))).collect()
    kept = rows + [r for r in odd(dim) if r[0] in (None, 906, 907)]
    k = min(32, dim)
    assert len(got) == len(kept) * k
    x = [[math.floor(v * 64) + 1_000_000 for v in e] for _, e in kept]
    n, s, y, c = exact_scatter(x)
    values, axes = np.linalg.eigh(np.array([[v / n**3 for v in r] for r in c]))
    values, axes = values[::-1], axes[:, ::-1]
    by = {(r.vec_id, r.component): r for r in got if r.vec_id is not None and r.vec_id < 900}
    z = np.array(y) / n @ axes / np.sqrt(values)
    signs = [np.sign(z[0, j] * by[0, j + 1].whitened) for j in range(k)]
    for i, (vec, _) in enumerate(rows):
        for j in range(k):
            r = by[vec, j + 1]
            assert r.n == n and r.deviation == sum(v * v for v in y[i]) == int(r.deviation_exact)
            assert r.whitened == pytest.approx(z[i, j] * signs[j], abs=1e-7)
            assert r.explained == pytest.approx(values[j] / values.sum(), rel=1e-9)
    assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-8


def test_whitening_without_spread(spark):
    """Equal vectors have no scale; a line has one component with a scale; nothing gives nothing."""
    same = whitening.whitening(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(same) == 4 and all(r.whitened is None and r.deviation == 0 and r.identity_error is None for r in same)
    line = whitening.whitening(vectors(spark, [(i, [float(i), 2.0 * i]) for i in range(9)])).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line) and line[0].identity_error < 1e-9
    assert whitening.whitening(vectors(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whitening(vectors(spark, []).limit(0)).count() == 0
    huge = whitening.whitening(vectors(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 5.0])])).collect()
    assert len(huge) == 6 and all((r.deviation is None) == (r.vec_id < 3) == (int(r.deviation_exact) >= 1 << 63) for r in huge)


def brute_clusters(rows, k=8, rounds=10, dim=64):
    x = [(i, [max(-balltree.LIMIT, min(balltree.LIMIT, math.floor(v * 1024))) for v in e]) for i, e in rows]
    first = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in x if i is not None)[:k]
    z = [v for _, v in first]
    for step in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(z)) for _, v in x]
        if step < rounds:
            for j in range(len(z)):
                own = [v for (_, v), f in zip(x, found) if f[1] == j]
                if own:
                    z[j] = [sum(col) // len(own) for col in zip(*own)]
    spent = [sum(q for q, j in found if j == c) for c in range(len(z))]
    return sorted((str(i), j, q, spent[j], sum(spent), hashlib.sha256(",".join(map(str, z[j])).encode()).hexdigest()) for (i, _), (q, j) in zip(x, found))


@pytest.mark.parametrize("case", ["groups", "copies", "few", "far"])
def test_clusters(spark, monkeypatch, case):
    monkeypatch.setattr(balltree, "BLOCK", 64)
    rows = made(300, 64, seed=3, groups=20)
    if case == "copies":
        rows = [(i, rows[0][1] if i % 3 else v) for i, v in rows]
    elif case == "few":
        rows = rows[:5]
    elif case == "far":
        rows = [(i, [x * (1e30 if i % 50 == 0 else 1000) for x in v]) for i, v in rows]
        rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    got = balltree.cluster_digest(vectors(spark, rows + odd(64))).collect()
    kept = rows + [r for r in odd(64) if r[0] in (None, 906, 907)]
    assert sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got) == brute_clusters(kept)


def test_no_vectors(spark):
    assert balltree.cluster_digest(vectors(spark, [(1, None), (2, [1.0])])).count() == 0
    assert balltree.cluster_digest(vectors(spark, []).limit(0)).count() == 0


def test_balls():
    """Every vector is in one leaf; balls hold theirs; whole balls are given away where centroids are clear."""
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.integers(-40, 40, (500, 8)) + at * 1000 for at in range(8)]).astype(np.int64)
    x[:700] = x[0]
    tree = balltree.build(x, leaf=10)
    leaves = np.flatnonzero(tree.child == 0)
    assert sorted(balltree._members(tree, leaves).tolist()) == list(range(len(x)))
    for i in range(len(tree.count)):
        own = tree.points[tree.start[i] : tree.start[i] + tree.count[i]]
        assert (own.sum(0) == tree.sum[i]).all()
        assert np.sqrt(((own - tree.centre[i]) ** 2).sum(1)).max() <= tree.radius[i] * (1 + 1e-9) + 1e-6
    z = np.array([[at * 1000] * 8 for at in range(8)])
    counts, sums, seen = balltree.sums_of(tree, z)
    labels, gaps = balltree.labels_of(tree, z)
    want = balltree.squared(tree.points, z)
    assert (labels == want.argmin(1)).all() and (gaps == want.min(1)).all()
    assert counts.tolist() == np.bincount(labels, minlength=8).tolist() and seen < len(x) / 4
    assert all((sums[c] == tree.points[labels == c].sum(0)).all() for c in range(8))
    wide = rng.integers(-(2**27), 2**27, (50, 8))
    assert balltree.squared(wide, wide[:3]).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, c)) for c in wide[:3]] for r in wide]


def test_sql_of_clusters(spark, sf_dir):
    c = duckdb.connect()
    c.sql(f"create view embeddings as select * from '{sf_dir}/embeddings.parquet'")
    got = queries.op13_centroid_clustering(spark, sf_dir).toPandas().sort_values("vec_id").reset_index(drop=True)
    want = c.sql(balltree.CLUSTER_SQL).df().sort_values("vec_id").reset_index(drop=True)[list(got.columns)]
    assert got.astype(str).equals(want.astype(str))


def test_arrow_rows_keep_null_ids():
    batch = pa.RecordBatch.from_arrays([pa.array([None, 4], pa.int64()), pa.array([[1, 2], [3, 4]], pa.list_(pa.int64()))], names=["vec_id", "x"])
    (tree,) = balltree._tree_rows(2)(iter([batch]))
    assert set(tree.column("ids")[0].as_py()) == {None, 4}
