"""Near duplicates, repeated passages and components against brute force, and the whole pipeline."""

from __future__ import annotations

import math
import random
import re
import time
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from docpipe.llm import _text as X
from docpipe.llm import neardup, substrings
from docpipe.llm._store import Scratch
from docpipe.llm.graph import components

from .helpers import documents, odd_rows, prose, with_clashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def brute_components(rows, width=4, percent=80):
    sets = defaultdict(set)
    size = {}
    for i, t in rows:
        w = words(t)
        s = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
        sets[i] |= s
        size[i] = len(s)
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}, size


def edited(text, seed, changes):
    rng = random.Random(seed)
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"e{rng.randrange(99)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def rows():
    base = [prose(i, 150) for i in range(12)]
    out = [(i, b) for i, b in enumerate(base)]
    out += [(100 + i, edited(base[i % 3], i, 1 + i % 5)) for i in range(60)]  # chains of near copies
    out += [(200 + i, base[5].upper() + "  ") for i in range(20)]  # copies but for case and blanks
    out += [(300, "one two"), (301, "One  TWO"), (302, "one"), (303, "two one")]
    return out + [r for r in odd_rows() if r[0] is not None]


@pytest.mark.parametrize("block, few", [(neardup.BLOCK_BYTES, neardup.FEW), (2000, 2), (2000, 1)])
def test_near_duplicates(spark, rows, monkeypatch, block, few):
    monkeypatch.setattr(neardup, "BLOCK_BYTES", block)
    monkeypatch.setattr(neardup, "FEW", few)
    docs = with_clashes(documents(spark, [*rows, (None, rows[0][1]), (None, None)])).repartition(3)
    got = neardup.near_duplicates(docs, 4, 80).collect()
    assert len(got) == len(rows) + 2
    want, size = brute_components(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles) == (want[r.doc_id], size[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)


def test_one_row_a_group_stays(spark, rows):
    docs = with_clashes(documents(spark, [*rows, (None, rows[0][1]), (None, None)]))
    kept = neardup.keep_first(docs, 4, 80)
    assert kept.columns == docs.columns
    want, _ = brute_components(rows)
    stays = set(want.values()) | {i for i, t in rows if not words(t)}
    assert sorted(r.doc_id for r in kept.select("doc_id").where("doc_id is not null").collect()) == sorted(stays)
    assert kept.where("doc_id is null").count() == 2


def grouped_texts(rows, width):
    """(id, text) -> number of its group of texts, by brute force; None without words."""
    keys = sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[0], r[1] or "", r[1] is None))
    numbers, _ = brute_components([(n, t) for n, (_, t) in enumerate(keys)], width)
    return {k: numbers[n] if words(k[1]) else None for n, k in enumerate(keys)}


def clashing_ids(seed):
    """Rows whose doc_ids repeat with equal texts, near copies and other texts."""
    rng = random.Random(seed)
    base = [prose(900 + i, 60 + i) for i in range(6)]
    out = []
    for k in range(40):
        text = base[rng.randrange(6)]
        out.append((rng.randrange(12), text if k % 3 else edited(text, k, rng.randrange(4))))
    return out + out[:5] + [(3, ""), (3, None), (4, "two words"), (5, "two words"), (None, base[0])]


PROBES = [
    [(1, "a b c d e f"), (2, "a b c d e f"), (2, "k l m n o p"), (3, "k l m n o p")],
    [(7, "a b c d e f"), (7, "k l m n o p")],
    clashing_ids(1),
    clashing_ids(2),
]


@pytest.mark.parametrize("rows", PROBES)
def test_no_text_goes_for_its_id(spark, rows):
    kept = [(r.doc_id, r.text) for r in neardup.keep_first(documents(spark, rows).repartition(3), 5, 80).collect()]
    group = grouped_texts(rows, 5)
    assert len(set(kept)) == len([k for k in kept if k[0] is not None]) + len({k for k in kept if k[0] is None})
    kept = [k for k in kept if k[0] is not None]
    assert set(kept) <= set(group)
    assert sorted(group[k] for k in kept if group[k] is not None) == sorted({g for g in group.values() if g is not None})
    assert {k for k in group if group[k] is None} <= set(kept)


@pytest.mark.parametrize("rows", PROBES)
def test_one_component_an_id(spark, rows):
    got = defaultdict(set)
    for r in neardup.near_duplicates(documents(spark, rows), 5, 80).collect():
        if r.doc_id is not None and r.n_shingles:
            got[r.doc_id].add(r.component_id)
    group = grouped_texts(rows, 5)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for (i, _), g in group.items():
        if g is not None:
            root[find(("id", i))] = find(("group", g))
    for i, found in got.items():
        same = [j for j in got if find(("id", j)) == find(("id", i))]
        assert found == {min(same)}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 6, 7])
def test_a_table_of_one_short_text(spark, n):
    docs = documents(spark, [(9, " ".join("hello" for _ in range(n)))])
    got = neardup.near_duplicates(docs, 4, 80).collect()
    assert [(r.doc_id, r.component_id, r.n_shingles, r.kept) for r in got] == [(9, 9, 1 if n else 0, True)]
    assert neardup.keep_first(docs).collect() == docs.collect()
    assert substrings.repeated_passages(docs, 50 if n % 2 else 5).count() == 0
    assert substrings.cut_repeats(docs, 5).collect() == docs.collect()


def test_a_short_text_after_a_full_batch(spark):
    docs = documents(spark, [(i, prose(i, 80)) for i in range(1000)] + [(1000, "hello world")]).coalesce(1)
    assert neardup.near_duplicates(docs, 4, 80).count() == 1001
    assert substrings.cut_repeats(docs).count() == 1001


def test_texts_of_one_id_are_cut_apart(spark):
    passage, own, whole = prose(950, 60), prose(951, 90), prose(952, 70)
    rows = [(1, f"{prose(953, 20)} {passage}"), (2, f"{passage} {prose(954, 20)}"), (2, own), (3, whole), (4, whole), (4, own + " end"), (5, own)]
    left = defaultdict(list)
    for r in substrings.cut_repeats(documents(spark, rows).repartition(2)).collect():
        left[r.doc_id].append(r.text)
    assert [words(t) for t in left[2]] in ([words(prose(954, 20)), words(own)], [words(own), words(prose(954, 20))])
    assert left[3] == [whole] and left[1] == [rows[0][1]]
    assert left[4] in (["end"], [" end"]) and 5 not in left


def test_stated_chance_of_a_missed_pair():
    chance = sum(math.comb(neardup.K, k) * 0.8**k * 0.2 ** (neardup.K - k) for k in range(neardup.MATCHES))
    assert f"{chance * 1e6:.1f} in a million" in neardup.__doc__


def test_no_rows(spark):
    assert neardup.near_duplicates(documents(spark, [])).count() == 0
    assert neardup.near_duplicates(documents(spark, [(1, None), (2, "")])).count() == 2
    assert substrings.repeated_passages(documents(spark, [])).count() == 0
    assert substrings.cut_repeats(documents(spark, [(1, None), (2, "")])).count() == 2


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(200 + i, 201 + i) for i in range(25)] + [(7, 7), (None, 1)]
    got = {r.v: r.root for r in components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark, "t")).collect()}
    root = {x: x for p in pairs for x in p if x is not None}
    for _ in root:
        for a, b in pairs:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    touched = {x for a, b in pairs if a is not None and a != b for x in (a, b)}
    assert got == {x: root[x] for x in touched}


def brute_repeats(rows, least=50):
    first: dict[tuple, int] = {}
    for i, t in sorted(rows):
        w = words(t)
        for p in range(len(w) - least + 1):
            first.setdefault(tuple(w[p : p + least]), i)
    marked = {}
    for i, t in rows:
        w = words(t)
        m = np.zeros(len(w), bool)
        for p in range(len(w) - least + 1):
            if first[tuple(w[p : p + least])] < i:
                m[p : p + least] = True
        marked[i] = m
    return marked


@pytest.fixture(scope="module")
def passages():
    shared, other = prose(70, 55), prose(71, 80)
    out = [(i, f"{prose(i, 40)} {shared} {prose(i + 500, 30)}") for i in range(25)]
    out += [(30 + i, f"{other} {prose(i + 900, 60)}\n{shared.upper()}") for i in range(4)]
    out += [(40, prose(3, 49)), (41, prose(3, 49)), (42, prose(4, 120)), (43, prose(4, 120)), (44, prose(4, 119))]
    out += [(50, f"{prose(80, 49)} {prose(81, 60)}"), (51, f"{prose(82, 60)} {prose(80, 49)}")]
    out += [(60, "of " * 400), (61, "x " + "of " * 300)]
    return out + [r for r in odd_rows() if r[0] is not None]


def test_repeated_passages(spark, passages):
    docs = with_clashes(documents(spark, [*passages, (None, passages[0][1])])).repartition(3)
    found = defaultdict(list)
    for r in substrings.repeated_passages(docs).collect():
        assert r.origin_id < r.doc_id and r.n_words == r.end - r.start >= 50
        found[r.doc_id].append((r.start, r.end))
    want = brute_repeats(passages)
    for i, m in want.items():
        got = np.zeros(len(m), bool)
        for a, b in found[i]:
            got[a:b] = True
        assert (got == m).all(), i
    cut = substrings.cut_repeats(docs)
    assert cut.columns == docs.columns
    texts = defaultdict(list)
    for r in cut.collect():
        texts[r.doc_id].append(r.text)
        assert r.text is None or r.n_chars == len(r.text)
    for i, t in passages:
        left = [w for w, m in zip(words(t), want[i]) if not m]
        if want[i].any():
            assert [words(x) for x in texts[i]] == ([left] if left else [])
        else:
            assert set(texts[i]) == {t}
    assert len(texts[None]) == 1


def edited_family(n, seed, words_in=80, apart=(25, 45)):
    """n texts, each with its own edited copy of one passage (an edit in 25 to 45 words) between words of its own."""
    rng = random.Random(seed)
    base = prose(seed + 9000, words_in).split()
    rows = []
    for i in range(n):
        copy, at = list(base), rng.randrange(*apart)
        while at < len(copy):
            copy[at] = f"edit{i}x{at}"
            at += rng.randint(*apart)
        rows.append((i, " ".join([prose(seed * 7 + 3 * i + 1, rng.randint(20, 60)), *copy, prose(seed * 11 + 5 * i + 2, rng.randint(20, 60))])))
    return rows


def all_pair_spans(rows, least=50):
    """The library's own verification over all pairs of texts, without candidate search."""
    parts = {i: X.shingle_table(*(lambda t: (t[0], t[3]))(X.word_table([t.encode().translate(X.SPACE_FOLD)])), 5, short=False)[0] for i, t in rows}
    marked = {}
    for i, mine in parts.items():
        marked[i] = np.zeros(len(mine) + 4, bool)
        for o, theirs in parts.items():
            if o < i:
                for p, q in substrings.near_spans(theirs, mine, least - 4):
                    marked[i][p : q + 4] = True
    return marked


@pytest.mark.parametrize("n,seed,block", [(60, 2, 2 << 20), (120, 1, 2 << 20), (120, 9, 20_000), (200, 4, 2 << 20)])
def test_families_of_edited_copies(spark, monkeypatch, n, seed, block):
    """No cap on the windows of a key: nearly all words that any pair confirms are found, and none beyond."""
    monkeypatch.setattr(substrings, "BLOCK_BYTES", block)
    rows = edited_family(n, seed)
    want = all_pair_spans(rows)
    got = {i: np.zeros(len(m), bool) for i, m in want.items()}
    for r in substrings.repeated_passages(documents(spark, rows).repartition(3)).collect():
        got[r.doc_id][r.start : r.end] = True
    assert sum(m.any() for m in want.values()) > n // 3
    assert not any((got[i] & ~want[i]).any() for i in want)
    both, all_words = (sum(int(m.sum()) for m in x.values()) for x in (got, want))
    assert both >= 0.99 * all_words, both / all_words
    assert sum(m.any() for m in got.values()) >= 0.99 * sum(m.any() for m in want.values())


@pytest.mark.parametrize("seed", range(3))
def test_joint_windows(seed):
    """The sweep against the definition over all pairs of windows."""
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 40 if seed == 2 else 1 << 40, 900).astype(np.uint64)
    rows = []
    for h in range(substrings.K):
        l, c, r = substrings.compact_windows(X.splitmix(values * X.seeds(substrings.K, 31)[h]), np.array([0, len(values)]), 46)
        kept = rng.random(len(l)) < 0.8
        rows += [(int(k) << 8 | h, int(a), int(e) + 5, int(m)) for k, a, e, m in zip(values[c][kept] & np.uint64((1 << 40) - 1), l[kept], r[kept], c[kept])]
    keys, start, end, at = (np.array(x, np.int64) for x in zip(*rows))
    keys = keys >> 8 << 2 | keys & 3
    marked = rng.random(len(keys)) < 0.5
    f = keys & 3
    want = set()
    for i in range(len(keys)):
        for j in range(len(keys)):
            lo, hi = max(start[i], start[j]), min(end[i], end[j])
            if f[i] < f[j] and (marked[i] or marked[j]) and lo <= min(at[i], at[j]) and max(at[i], at[j]) + 5 <= hi and hi - lo >= 50:
                want.add((i, j))
    i, j = substrings.joint_windows(keys, start, end, at, marked, 50)
    assert len(i) == len(want) > 10 and set(zip(i.tolist(), j.tolist())) == want


def test_joint_windows_of_a_long_text():
    """Linear in the windows: a text of 400,000 words takes seconds."""
    values = np.random.default_rng(1).integers(0, 1 << 60, 400_000).astype(np.uint64)
    parts = [substrings.compact_windows(X.splitmix(values ^ X.seeds(4, 31)[h]), np.array([0, len(values)]), 46) for h in range(4)]
    keys = np.concatenate([np.full(len(p[0]), h) for h, p in enumerate(parts)])
    start, at, end = (np.concatenate([p[k] for p in parts]) for k in range(3))
    began = time.process_time()
    i, _ = substrings.joint_windows(keys, start, end + 5, at, np.ones(len(keys), bool), 50)
    assert len(i) > 100_000 and time.process_time() - began < 30


def test_common_counts():
    rng = np.random.default_rng(4)
    one, other = ([rng.choice(300, n, replace=False).astype(np.uint64) for n in rng.integers(0, 90, k)] for k in (30, 20))
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in other] for a in one]
    both = np.intersect1d(np.concatenate(one), np.concatenate(other))
    for width in (7, 4096):
        assert substrings.common_counts(substrings.membership(one, both), substrings.membership(other, both), width).tolist() == want


def brute_near(rows, least=50):
    """Words in passages whose end shingles agree with an earlier document's passage, of similarity 0.8 or more."""
    marked = {}
    grams = {i: [tuple(w[k : k + 5]) for k in range(len(w) - 4)] for i, t in rows for w in [words(t)]}
    for i, mine in grams.items():
        marked[i] = np.zeros(len(mine) + 4 if mine else 0, bool)
        for o, theirs in grams.items():
            if o >= i:
                continue
            points = [(p, q) for p, g in enumerate(theirs) for q, h in enumerate(mine) if g == h]
            for p, q in points:
                for r, s in points:
                    if r - p + 5 < least or s - q + 5 < least or marked[i][q : s + 5].all():
                        continue
                    x, y = set(theirs[p : r + 1]), set(mine[q : s + 1])
                    if 100 * len(x & y) >= 80 * len(x | y):
                        marked[i][q : s + 5] = True
    return marked


def test_passages_with_edits(spark):
    base = prose(601, 200).split()
    replaced, shifted, loose = list(base), list(base), list(base)
    for k in (45, 90, 135, 180):
        replaced[k] = f"new{k}"
    for k in (180, 135, 90, 45):
        shifted.insert(k, f"more{k}")
    for k in range(10, 200, 12):
        loose[k] = f"far{k}"
    texts = [base, replaced, shifted, loose]
    rows = [(i, " ".join([prose(610 + i, 30), *t, prose(620 + i, 30)])) for i, t in enumerate(texts)]
    want = brute_near(rows)
    assert want[1].sum() == 200 and want[2].any() and not want[3].any()
    assert not any(m.any() for m in brute_repeats(rows).values())
    docs = documents(spark, rows).repartition(3)
    found = {i: np.zeros(len(m), bool) for i, m in want.items()}
    for r in substrings.repeated_passages(docs).collect():
        assert r.origin_id == 0
        found[r.doc_id][r.start : r.end] = True
    assert all((found[i] == want[i]).all() for i in want)
    left = {r.doc_id: words(r.text) for r in substrings.cut_repeats(docs).collect()}
    assert left == {i: [w for w, m in zip(words(t), want[i]) if not m] for i, t in rows}


@pytest.mark.parametrize("seed", range(6))
def test_near_spans(seed):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 12 if seed < 2 else 500, 60).astype(np.uint64)
    b = np.concatenate([a[5:25], rng.integers(600, 700, 2 + seed).astype(np.uint64), a[26:50], a[:8]])
    want = np.zeros(len(b), bool)
    points = [(i, j) for i in range(len(a)) for j in range(len(b)) if a[i] == b[j]]
    for i, j in points:
        for p, q in points:
            if p - i + 1 >= 15 and q - j + 1 >= 15 and not want[j : q + 1].all():
                x, y = set(a[i : p + 1].tolist()), set(b[j : q + 1].tolist())
                want[j : q + 1] |= 100 * len(x & y) >= 80 * len(x | y)
    got = np.zeros(len(b), bool)
    for j, q in substrings.near_spans(a, b, 15):
        got[j:q] = True
    assert not (got & ~want).any()
    if seed >= 2:
        assert (got == want).all()


def test_compact_windows_cover_each_range_once():
    rng = np.random.default_rng(1)
    rows = [rng.integers(0, 30, 60), np.zeros(40, int), np.zeros(0, int), rng.permutation(50), np.arange(7), np.arange(6)]
    first = np.cumsum([0] + [len(r) for r in rows])
    values = np.concatenate(rows).astype(np.uint64)
    windows = list(zip(*(x.tolist() for x in substrings.compact_windows(values, first, 7))))
    for p, q in zip(first, first[1:]):
        for i in range(p, q):
            for j in range(i + 6, q):
                inside = [(a, c, b) for a, c, b in windows if a <= i <= c <= j <= b]
                assert len(inside) == 1 and values[inside[0][1]] == values[i : j + 1].min()
    assert all(any(p <= a and b < q for p, q in zip(first, first[1:])) for a, _, b in windows)
    assert not len(substrings.compact_windows(values[:0], np.array([0, 0]), 7)[0])


@pytest.mark.parametrize("seed", range(4))
def test_no_hopeful_pair_is_passed_over(seed):
    rng = np.random.default_rng(seed)
    pairs = []
    for k in range(60):
        a = rng.integers(0, 5000 if k % 3 else 60, 80).astype(np.uint64)
        b = a.copy()
        for i in rng.choice(80, k, replace=False):
            b[i] = 9000 + i
        pairs.append((a, b[: 60 + k % 20]))
    cat = lambda side: (np.concatenate([p[side] for p in pairs]), np.cumsum([0] + [len(p[side]) for p in pairs]))
    may = dict(substrings.segments_of_pairs(*cat(0), *cat(1), 46))
    found = [substrings.near_spans(a, b, 46) for a, b in pairs]
    for (a, b), want in zip(pairs, found):  # the other ways to the same ranges
        if len(set(a.tolist())) == len(a) and len(set(b.tolist())) == len(b):
            shared = np.flatnonzero(np.isin(b, a)).tolist()
            assert substrings.spans_by_place({v: i for i, v in enumerate(a.tolist())}, b.tolist(), shared, 46) == want
            with pytest.MonkeyPatch.context() as m:
                m.setattr(substrings, "FEW_RUNS", -1)
                assert substrings.near_spans(a, b, 46) == want
    assert any(found) and len(may) < 60 and all(k in may for k, f in enumerate(found) if f)
    for k, segments in may.items():
        if segments is not None:
            assert segments.tolist() == sorted(substrings._segments(*pairs[k]).tolist(), key=lambda x: x[1])
            assert substrings.near_spans(*pairs[k], 46, runs=segments) == found[k]
    assert any(s is not None for s in may.values())


def test_pipeline(spark, tmp_path, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in out} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_stages_against_brute_force(spark, sf_dir):
    """Each stage on its own input, row by row."""
    import corpus_pipeline

    from .test_exact import brute_hits

    stage = dict(corpus_pipeline.STAGES)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    base = [prose(700 + i, 120) for i in range(8)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20 + i, edited(base[i % 4], i, i % 7)) for i in range(24)]
    rows += [(60 + i, f"{prose(760 + i, 40)} {' '.join(base[7].split()[20:90])} {prose(780 + i, 30)}") for i in range(5)]
    rows += [(80 + i, f"{prose(800 + i, 60)} {items[i][1]} {prose(820 + i, 20)}") for i in range(3)]
    rows += [r for r in odd_rows() if r[0] is not None and (r[1] is None or len(r[1]) < 50_000)]
    kept = {(r.doc_id, r.text) for r in stage["near_dedup"](spark, documents(spark, rows), sf_dir).collect()}
    group = grouped_texts(rows, 5)
    first = {}
    for k, g in group.items():
        if g is not None and (g not in first or k[0] < first[g][0]):
            first[g] = k
    rows = sorted(kept, key=lambda r: r[0])
    assert kept == set(first.values()) | {k for k, g in group.items() if g is None}
    cut = {r.doc_id: r.text for r in stage["substring_dedup"](spark, documents(spark, rows), sf_dir).collect()}
    exact, near = brute_repeats(rows), brute_near([r for r in rows if r[0] < 1000])
    for i, t in rows:
        marked = exact[i] | near[i] if i in near else exact[i]
        left = [w for w, m in zip(words(t), marked) if not m]
        assert words(cut.get(i)) == left and (marked.any() or cut[i] == t)
    assert any(m.any() for m in exact.values())
    clean = {r.doc_id for r in stage["decontamination"](spark, documents(spark, rows), sf_dir).collect()}
    assert clean == {i for i, t in rows if not brute_hits(t, items)[4]} and len(clean) < len(rows)


def test_pipeline_odd_rows(spark, sf_dir):
    import corpus_pipeline

    for extra in (odd_rows(), []):
        docs = documents(spark, extra)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= 0


@pytest.mark.parametrize("seed", range(8))
def test_open_ranges(seed):
    """All that near_spans covers beyond the places that are done, nothing else; the bounds keep all of it."""
    rng = np.random.default_rng(seed)
    a = rng.permutation(400)[:260].astype(np.uint32)
    b = np.concatenate([a[150:240], rng.permutation(50)[:5] + 900, a[10:140]]).astype(np.uint32)
    b[rng.choice(len(b), 12, replace=False)] = np.arange(12) + 1000
    done = np.zeros(len(b), bool)
    done[20 * seed : 20 * seed + 60] = True
    want = done.copy()
    for p, q in substrings.near_spans(a, b, 46):
        want[p:q] = True
    entries = np.unique(b)
    row = substrings.places_table([a], entries)[:, np.searchsorted(entries, b)]
    held = row > 0
    assert (row[0][held[0]] - 1 == [a.tolist().index(x) for x in b[held[0]]]).all()
    lone = np.ones(len(b), bool)
    for reach in (substrings.may_reach(held, 46, row)[0], substrings.may_reach(held, 46, lone=lone)[0]):
        assert (reach | done)[want].all()
    substrings.open_ranges(row[0], done, 46)
    assert want.any() and (done == want).all()
    assert substrings.open_ranges(row[0], done, 46) == []
    assert substrings.hold_once([b, np.array([1, 2, 1], np.uint32), b[:0]]).tolist() == [True, False, True]


def test_joint_windows_of_keys_of_any_size():
    """Joint windows are made of a text's windows alone, not of how many others its keys have."""
    kind = pa.list_(pa.struct([("key", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("at", pa.int32()), ("live", pa.bool_())]))
    windows = [{"key": 4, "start": 0, "end": 120 << 32, "at": 30, "live": True}, {"key": 9, "start": 10 << 32, "end": 130 << 32, "at": 60, "live": True}]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([7, 8]), pa.array([windows, windows[:1]], kind)], names=["doc_id", "tag", "windows"])
    rows = [r for b in substrings._joint_rows(50)([batch]) for r in b.to_pylist()]
    assert [(r["doc_id"], r["live"], r["first"], r["after"]) for r in rows] == [(1, True, 0, 126)]
