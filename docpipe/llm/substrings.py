"""Repeated passages across documents, found by compact windows and removed after their first occurrence.

1. The words of a document give a sequence of word-shingle hashes. For each of K
   hash functions a Cartesian tree over the sequence groups all its subsequences
   of at least MIN_WORDS words by the place of their minimum: one compact window
   (l, c, r) stands for every subsequence inside it that contains c, and its key
   is the minimum. A passage that two documents share gives both a window with
   the same key for every hash function.
2. Keys that occur in two different documents are kept (map-side combined counts,
   no lists). Joined back, they leave each document's shared windows. An equal
   passage lies in shared windows of all K functions, so the words that those
   cover are its candidates.
3. Equal passages: inside candidate words every run of MIN_WORDS words is hashed,
   and the least document of each hash is its first occurrence. Runs whose first
   occurrence is in an earlier document are repeats; their union gives the spans.
   This is linear in the candidate words and compares no pairs, so a passage that
   many documents hold costs as much a copy as one that two hold.
4. Near-duplicate passages: windows with equal keys are joined as intervals to
   document pairs, with the hash functions that agree and the ranges their windows
   span; pairs that agree in AGREE functions are verified on those ranges of the
   texts: two passages of MIN_WORDS words or more whose first shingles and last
   shingles are equal are near duplicates if the Jaccard similarity of their sets
   of WIDTH-word shingles is PERCENT or more. A pair of similarity s agrees in a
   hash function with probability s, so at 0.8 it has fewer than AGREE of K with
   a probability of 2.7 %, at 0.9 of 0.4 %. Pairs come in two steps:
   a. every document with the first document of each of its keys, so a group of
      near copies costs about one pair a member;
   b. windows whose minimum lies in no passage found so far, by joint windows (two
      windows of different functions whose common range holds both minima, posted
      under both keys): texts that share a joint key are compared on the ranges
      that both windows span. Keys with one first document are one group, so a
      text goes there once, with the range of all its windows in the group and
      bits for what is covered. The rule is the same for keys of any size. Groups
      larger than BLOCK_BYTES meet in pairs of blocks. Shared shingles (32-bit
      hashes) and shared keys of all pairs are counted by matrix products; pairs
      that share too few shingles for a passage go, and the others are verified,
      the fullest first, as long as a place that is not covered may lie in a range
      of both. So no key, however large, meets one task, and none of its pairs is
      left out.

Documents with the same word sequence are one text; all but the least doc_id are
whole repeats (if they have MIN_WORDS words). Words are compared with A-Z lowered
and white space folded. "First" is by doc_id; repeats inside one document stay.

Defined cases: null and empty texts have no words; documents of fewer than
MIN_WORDS words have no repeats; a null doc_id neither repeats nor is repeated;
rows with the same doc_id and text are one document; rows with the same doc_id
and different texts are told apart, and not compared with each other; other
columns are kept by cut_repeats and ignored else.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from . import _text as X
from ._store import Scratch

MIN_WORDS = 50
WIDTH = 5
K, AGREE = 4, 2
PERCENT = 80
BLOCK_BYTES = 1 << 20  # shingles of one side of a pair of blocks
STAGE = 32  # partners of a range whose bounds are computed first; then eight times as many, and so on
FEW_RUNS = 64
MINE, THEIRS = 1, 2  # roles of a range in a block: it is searched for, it is compared with
RUN_CELLS = 1 << 18  # pairs of runs of equal shingles that are looked at together
TABLE_BYTES = 32 << 20  # of one table of which text has which shingle

_MULTIPLIERS = X.seeds(K, 31)
_KEY_SEEDS = X.seeds(K, 37)
_FUNCTION = np.uint64(K - 1)  # the low bits of a key name its hash function; K is a power of two
_BASE_ROW = "doc_id long, tag long, n_words long, hi long, lo long, key array<long>, start array<long>, end array<long>, at array<int>"


def compact_windows(values: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """l, c, r (inclusive) of the Cartesian trees' nodes whose range has `least` entries or more.

    There is one tree for each sequence values[first[i]:first[i + 1]]; all trees
    grow together, a level at a time. Of equal minima the middle one is the
    node, so a constant sequence gives a balanced tree too.
    """
    lo, hi = np.asarray(first[:-1], np.int64), np.asarray(first[1:], np.int64)
    wide = hi - lo >= least
    lo, hi = lo[wide], hi[wide]
    ended = np.append(values, values[-1:])  # so that an end may be the length
    out = []
    while len(lo):
        sizes = hi - lo
        low = np.minimum.reduceat(ended, np.stack([lo, hi], 1).ravel())[::2]
        begin = np.cumsum(sizes) - sizes
        where = np.arange(begin[-1] + sizes[-1]) + np.repeat(lo - begin, sizes)
        equal = ended[where] == np.repeat(low, sizes)
        same = np.add.reduceat(equal.astype(np.int64), begin)
        c = where[equal][np.cumsum(same) - same + same // 2]
        out.append((lo, c, hi - 1))
        lo, hi = np.stack([lo, c + 1], 1).ravel(), np.stack([c, hi], 1).ravel()
        wide = hi - lo >= least
        lo, hi = lo[wide], hi[wide]
    parts = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
    return parts[0], parts[1], parts[2]


def _window_rows(min_words: int):
    """Windows of each text; start and end hold a word number << 32 | its byte offset, so both have one order."""
    least = min_words - WIDTH + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "text"):
            texts = [t.translate(X.SPACE_FOLD) for t in X.text_bytes(batch.column("text"))]
            words, begin, stop, first = X.word_table(texts)
            shingles, at = X.shingle_table(words, first, WIDTH, short=False)
            digest = [hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest() for a, b in zip(first, first[1:])]
            found = []
            for h in range(K):
                values = shingles * _MULTIPLIERS[h]
                l, c, r = compact_windows(values, at, least)
                found.append((l, c, r, X.splitmix(values[c] ^ _KEY_SEEDS[h]) & ~_FUNCTION | np.uint64(h)))
            l, c, r, key = (np.concatenate(x) for x in zip(*found))
            doc = np.searchsorted(at, c, side="right") - 1
            order = np.argsort(doc, kind="stable")
            doc, key = doc[order], key[order]
            # Numbers of words in the text, and in the slice (all of a text's words but the last few begin a shingle).
            start, low, end = ((x[order] - at[doc]) for x in (l, c, r + WIDTH))
            starts, ends = start << 32 | begin[first[doc] + start], end << 32 | stop[first[doc] + end - 1]
            cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
            code = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("tag"),
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.array(code[:, 0]),
                    pa.array(code[:, 1]),
                    X.list_array(key.view(np.int64), cuts, pa.int64()),
                    X.list_array(starts, cuts, pa.int64()),
                    X.list_array(ends, cuts, pa.int64()),
                    X.list_array(low.astype(np.int32), cuts, pa.int32()),
                ],
                names=["doc_id", "tag", "n_words", "hi", "lo", "key", "start", "end", "at"],
            )

    return run


def _list_parts(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(offsets, field -> values) of a column of arrays of structs, for numpy."""
    inner = column.flatten()
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), {
        inner.type.field(k).name: inner.field(k).to_numpy(zero_copy_only=False) for k in range(inner.type.num_fields)
    }


def covered(function: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in shared windows of all hash functions."""
    count = np.zeros(n, np.int8)
    for h in range(K):
        edge = np.zeros(n + 1, np.int32)
        of = function == h
        np.add.at(edge, np.minimum(start[of], n), 1)
        np.add.at(edge, np.minimum(end[of], n), -1)
        count += np.cumsum(edge[:n]) > 0
    return count == K


def _run_rows(min_words: int):
    """(doc_id, tag, run, places): each distinct hash of a run of words inside a document's candidates, once.

    places holds start, number of starts in a row, start, ... of the run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "text"):
            texts = [t.translate(X.SPACE_FOLD) for t in X.text_bytes(batch.column("text"))]
            words, _, _, first = X.word_table(texts)
            runs, at = X.shingle_table(words, first, min_words, short=False)
            rows, hashes, places, sizes = [], [], [], [0]
            cuts, w = _list_parts(batch.column("windows"))
            function, start, end = w["key"].view(np.uint64) & _FUNCTION, w["start"] >> 32, w["end"] >> 32
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                n = int(first[i + 1] - first[i])
                if n < min_words:
                    continue
                inside = np.concatenate([[0], np.cumsum(covered(function[a:b], start[a:b], end[a:b], n))])
                pos = np.flatnonzero(inside[min_words:] - inside[:-min_words] == min_words)
                if not len(pos):
                    continue
                value = runs[at[i] : at[i + 1]][pos]
                order = np.argsort(value, kind="stable")
                value, pos = value[order], pos[order]
                change = value[1:] != value[:-1]
                begin = np.flatnonzero(np.concatenate([[True], change | (pos[1:] != pos[:-1] + 1)]))
                times = np.diff(np.concatenate([begin, [len(pos)]]))
                head = np.flatnonzero(np.concatenate([[True], value[begin][1:] != value[begin][:-1]]))
                rows.append(np.full(len(head), i))
                hashes.append(value[begin][head])
                places.append(np.stack([pos[begin], times], 1).ravel().astype(np.int32))
                sizes.extend((sizes[-1] + 2 * np.concatenate([head[1:], [len(begin)]])).tolist())
            if rows:
                source = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(source),
                        batch.column("tag").take(source),
                        pa.array(np.concatenate(hashes).view(np.int64)),
                        X.list_array(np.concatenate(places), np.array(sizes), pa.int32()),
                    ],
                    names=["doc_id", "tag", "run", "places"],
                )

    return run


def _segments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(i, j, length) of the runs of equal shingles along a diagonal, by j.

    A shingle that a holds more than once goes on with its neighbour's diagonal if
    it can, seen from the left and, as another reading, from the right.
    """
    order = np.argsort(a, kind="stable")
    ranked = a[order]
    low, high = np.searchsorted(ranked, b), np.searchsorted(ranked, b, "right")
    hit = np.flatnonzero(high > low)
    if not len(hit):
        return np.zeros((0, 3), np.int64)
    readings = [order[low[hit]]]
    if (high[hit] - low[hit] > 1).any():
        places, spots = order.tolist(), list(zip(hit.tolist(), low[hit].tolist(), high[hit].tolist()))
        readings = []
        for turn in (1, -1):
            at, last, before = [], -1, -2
            for j, lo, hi in spots[::turn]:
                q = bisect_left(places, last + turn, lo, hi) if last >= 0 else -1
                if q < 0 or j != before + turn or q == hi or places[q] != last + turn:
                    if turn == 1:
                        q = min(bisect_right(places, last, lo, hi), hi - 1) if last >= 0 else lo
                    else:
                        q = max(bisect_left(places, last, lo, hi) - 1, lo) if last >= 0 else hi - 1
                last, before = places[q], j
                at.append(last)
            readings.append(np.array(at[::turn]))
    out = []
    for at in readings:
        head = np.flatnonzero(np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(at) != 1)]))
        out.append(np.stack([at[head], hit[head], np.diff(np.concatenate([head, [len(hit)]]))], 1))
    return out[0] if len(out) == 1 else np.unique(np.concatenate(out), axis=0)


def segments_of_pairs(
    a: np.ndarray, a_first: np.ndarray, b: np.ndarray, b_first: np.ndarray, least: int, percent: int = PERCENT
) -> Iterator[tuple[int, np.ndarray | None]]:
    """(pair, segments as in _segments) of the pairs of sequences that may have near-duplicate ranges.

    Segments are None for pairs in which an entry comes twice on a side. In all
    others two ranges of `least` or more must share 2 * percent / (100 + percent)
    of that; pairs that share less are left out.
    """
    n = len(a_first) - 1
    pair = np.concatenate([np.repeat(np.arange(n), np.diff(x)) for x in (a_first, b_first)])
    place = np.concatenate([np.arange(len(a)) - a_first[pair[: len(a)]], np.arange(len(b)) - b_first[pair[len(a) :]]])
    mixed = X.splitmix(np.concatenate([a, b]) + X.splitmix(pair.astype(np.uint64)))
    order = np.argsort(mixed, kind="stable")  # of equal entries those of a come first
    mixed = mixed[order]
    hit = np.flatnonzero(mixed[1:] == mixed[:-1])
    one, other = order[hit], order[hit + 1]
    across = (one < len(a)) & (other >= len(a))
    twice = np.bincount(pair[one[~across]], minlength=n) > 0
    one, other = one[across], other[across]
    common = np.bincount(pair[one], minlength=n)
    may = ~twice & ((100 + percent) * common >= 2 * percent * least)
    wanted = may[pair[one]]
    k, i, j = pair[one[wanted]], place[one[wanted]], place[other[wanted]]
    order = np.lexsort((j, k))
    k, i, j = k[order], i[order], j[order]
    head = np.flatnonzero(np.concatenate([[True], (np.diff(k) != 0) | (np.diff(i) != 1) | (np.diff(j) != 1)])) if len(k) else np.zeros(0, np.int64)
    table = np.stack([i[head], j[head], np.diff(np.append(head, len(k)))], 1)
    cuts = np.searchsorted(k[head], np.arange(n + 1))
    for p in np.flatnonzero(may | twice).tolist():
        yield p, None if twice[p] else table[cuts[p] : cuts[p + 1]]


def near_spans(a: np.ndarray, b: np.ndarray, least: int, percent: int = PERCENT, runs: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Ranges of shingles of b, of `least` or more, that are near duplicates of a range of a.

    A passage pair runs from the start of one segment to the end of another: a
    shorter one inside the same segments has no greater similarity. `runs` are the
    segments of sequences that hold no entry twice, if they are known.
    """
    single = runs is not None or (len(set(a.tolist())) == len(a) and len(set(b.tolist())) == len(b))
    runs = _segments(a, b) if runs is None else runs
    if single and (100 + percent) * runs[:, 2].sum() < 2 * percent * least:
        return []
    if len(runs) < 2:  # one run is an equal passage
        return [(int(j), int(j + n)) for _, j, n in runs if n >= least]
    runs = runs[np.argsort(runs[:, 1], kind="stable")]
    if single and len(runs) <= FEW_RUNS:
        return _near_few(runs.tolist(), least, percent)
    from_a, from_b = runs[:, 0], runs[:, 1]
    to_a, to_b = from_a + runs[:, 2], from_b + runs[:, 2]
    if single:  # each shingle is in one run
        before = np.cumsum(runs[:, 2])
        along = np.argsort(from_a)
        within = np.empty(len(runs), np.int64)
        within[along] = np.cumsum(runs[along, 2])
    else:
        sides = [(_previous(x), np.isin(x, y)) for x, y in ((a, b), (b, a))]
    found: list[tuple[int, int]] = []
    reach = 0
    last = int(to_b.max())
    for s in range(len(runs)):
        i, j = int(from_a[s]), int(from_b[s])
        if last <= reach or last - j < least:
            break
        e = np.flatnonzero((to_a >= i + least) & (to_b >= max(j + least, reach + 1)))
        if not len(e):
            continue
        # The most that both can share, of the numbers of distinct shingles.
        if single:
            most = np.minimum(within[e] - within[s], before[e] - before[s]) + runs[s, 2]
            total = to_a[e] - i + to_b[e] - j
        else:
            most, total = None, 0
            for (seen, shared), at, to in zip(sides, (i, j), (to_a[e], to_b[e])):
                end = int(to.max())
                new = seen[at:end] < at
                kept = np.cumsum(new & shared[at:end])[to - at - 1]
                most = kept if most is None else np.minimum(most, kept)
                total = total + np.cumsum(new)[to - at - 1]
        e = e[100 * most >= percent * (total - most)]
        for t in e[np.argsort(-to_b[e], kind="stable")].tolist():
            p, q = int(to_a[t]), int(to_b[t])
            if single:
                inside = runs[s : t + 1]
                both = int(inside[(inside[:, 0] >= i) & (inside[:, 0] < p), 2].sum())
                total = p - i + q - j
            else:
                x, y = set(a[i:p].tolist()), set(b[j:q].tolist())
                both, total = len(x & y), len(x) + len(y)
            if 100 * both >= percent * (total - both):
                found.append((j, q))
                reach = q
                break
    return found


def _near_few(runs: list[list[int]], least: int, percent: int) -> list[tuple[int, int]]:
    """near_spans for a few runs, by start in b, of sequences that hold no entry twice."""
    from_a, from_b, sizes = map(list, zip(*runs))
    to_a, to_b, before = [], [], [0]
    for i, j, n in zip(from_a, from_b, sizes):
        to_a.append(i + n)
        to_b.append(j + n)
        before.append(before[-1] + n)
    found: list[tuple[int, int]] = []
    reach, end = 0, len(sizes)
    for s in range(end):
        i, j = from_a[s], from_b[s]
        if to_b[-1] <= reach or to_b[-1] - j < least:
            break
        for t in range(end - 1, s - 1, -1):
            p, q = to_a[t], to_b[t]
            if q < j + least or q <= reach:
                break
            most, total = before[t + 1] - before[s], p - i + q - j
            if p < i + least or 100 * most < percent * (total - most):
                continue
            both = sum(sizes[x] for x in range(s, t + 1) if i <= from_a[x] < p)
            if 100 * both >= percent * (total - both):
                found.append((j, q))
                reach = q
                break
    return found


def spans_by_place(place: dict[int, int], b: list[int], shared: list[int], least: int, percent: int = PERCENT) -> list[tuple[int, int]]:
    """near_spans of sequences that hold no entry twice; place: where a has its entries; shared: the places of b whose entries a has."""
    if (100 + percent) * len(shared) < 2 * percent * least:
        return []
    runs: list[list[int]] = []
    next_i = next_j = -1
    for j in shared:
        i = place[b[j]]
        if i == next_i and j == next_j:
            runs[-1][2] += 1
        else:
            runs.append([i, j, 1])
        next_i, next_j = i + 1, j + 1
    if len(runs) == 1:  # an equal passage
        return [(runs[0][1], next_j)] if len(shared) >= least else []
    return _near_few(runs, least, percent)


def _previous(values: np.ndarray) -> np.ndarray:
    """The place of the last equal entry before each entry, or -1."""
    order = np.argsort(values, kind="stable")
    out = np.full(len(values), -1, np.int64)
    equal = values[order][1:] == values[order][:-1]
    out[order[1:][equal]] = order[:-1][equal]
    return out


def _near_rows(min_words: int):
    """(doc_id, tag, places, origin) of the near-duplicate passages of pairs of text ranges, with places as in _run_rows."""
    least = min_words - WIDTH + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "part"):
            sides = []
            for name in ("part", "first_part"):
                words, _, _, first = X.word_table([t.translate(X.SPACE_FOLD) for t in X.text_bytes(batch.column(name))])
                sides.append(X.shingle_table(words, first, WIDTH, short=False))
            (mine, at), (theirs, first) = sides
            rows, places = [], []
            starts = batch.column("start").to_pylist()
            for k, segments in segments_of_pairs(theirs, first, mine, at, least):
                start = starts[k]
                found = near_spans(theirs[first[k] : first[k + 1]], mine[at[k] : at[k + 1]], least, runs=segments)
                if found:
                    rows.append(k)
                    places.append([x for p, q in found for x in (p + start, q - p - least + 1)])
            if rows:
                source = pa.array(rows, pa.int64())
                ids = [batch.column(n).take(source) for n in ("doc_id", "tag", "origin")]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(places, pa.list_(pa.int32()))], names=["doc_id", "tag", "origin", "places"])

    return run


def _first_pairs(shared: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs of each text with the texts of the first document of its windows' keys."""
    first = shared.where("doc_id = first").groupBy("key", F.col("tag").alias("o_tag")).agg(F.min("start").alias("o_start"), F.max("end").alias("o_end"))
    first = scratch.save(first)  # written: a plain input, so that a hot key is split
    bits = F.expr(f"shiftleft(1, cast(key & {K - 1} as int))").alias("bits")
    rows = shared.where("doc_id > first").select("key", bits, "doc_id", "tag", "start", "end", F.col("first").alias("origin"))
    return _agreeing(rows.join(first, "key"))


def _agreeing(rows: DataFrame) -> DataFrame:
    """The text pairs whose rows agree in AGREE hash functions, with the ranges their windows span."""
    spans = (f(c).alias(c) for f, c in ((F.min, "o_start"), (F.max, "o_end"), (F.min, "start"), (F.max, "end")))
    pairs = rows.groupBy("origin", "o_tag", "doc_id", "tag").agg(F.bit_or("bits").alias("agree"), *spans)
    return pairs.where(F.bit_count("agree") >= AGREE).drop("agree")


def _nesting(start: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The place of the innermost range around each, or -1; ranges are nested or apart, by start and the longer first."""
    above = np.full(len(start), -1)
    open_ranges: list[int] = []
    for k, (a, b) in enumerate(zip(start.tolist(), last.tolist())):
        while open_ranges and last[open_ranges[-1]] < a:
            open_ranges.pop()
        if open_ranges:
            above[k] = open_ranges[-1]
        open_ranges.append(k)
    return above


def joint_windows(keys: np.ndarray, start: np.ndarray, end: np.ndarray, at: np.ndarray, marked: np.ndarray, least: int):
    """(i, j) of two windows of one text and different functions, one of them marked, that hold a common range with both minima.

    The range of `least` words or more stands for all subsequences whose minima are
    those of both windows. The windows of a function are nested or apart, so those
    around a minimum are a chain: all chains are climbed together, a step at a time.
    """
    function = (keys.view(np.uint64) & _FUNCTION).astype(np.int64)
    last = end - WIDTH
    found = []
    for g in range(1, K):
        of = np.flatnonzero(function == g)
        of = of[np.lexsort((-last[of], start[of]))]
        i = np.flatnonzero(function < g)
        if not len(of) or not len(i):
            continue
        above, ends = _nesting(start[of], last[of]), last[of]
        spot = np.searchsorted(start[of], at[i], side="right") - 1
        while True:
            out = (spot >= 0) & (ends[spot] < at[i])
            if not out.any():
                break
            spot[out] = above[spot[out]]
        while len(i):
            i, spot = i[spot >= 0], spot[spot >= 0]
            j = of[spot]
            good = (marked[i] | marked[j]) & (start[i] <= at[j]) & (at[j] <= last[i])
            good &= np.minimum(end[i], end[j]) - np.maximum(start[i], start[j]) >= least
            found.append((i[good], j[good]))
            spot = above[spot]
    parts = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 2
    return parts[0], parts[1]


def _joint_rows(min_words: int):
    """(doc_id, tag, live, key, first, after) of the joint windows of each text, with the shingles of their range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cuts, w = _list_parts(batch.column("windows"))
            found = []
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                keys, start, end, at, live = (w[c][a:b] for c in ("key", "start", "end", "at", "live"))
                start, end, live = start >> 32, end >> 32, live.astype(bool)
                i, j = joint_windows(keys, start, end, at, np.ones(len(keys), bool), min_words)
                u = keys.view(np.uint64)
                swap = (u[i] & _FUNCTION) > (u[j] & _FUNCTION)
                x, y = np.where(swap, u[j], u[i]), np.where(swap, u[i], u[j])
                key = X.splitmix(x * _KEY_SEEDS[0] + X.splitmix(y)).view(np.int64)
                found.append((np.full(len(i), k), live[i] & live[j], key, np.minimum(start[i], start[j]), np.maximum(end[i], end[j]) - WIDTH + 1))
            source, live, key, first, after = (np.concatenate(c) for c in zip(*found))
            columns = [pa.array(live), pa.array(key), pa.array(first, pa.int32()), pa.array(after, pa.int32())]
            ids = [batch.column(n).take(pa.array(source)) for n in ("doc_id", "tag")]
            yield pa.RecordBatch.from_arrays([*ids, *columns], names=["doc_id", "tag", "live", "key", "first", "after"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, min_words: int) -> DataFrame:
    """Near-duplicate passages of the pairs; only the ranges of the texts are moved, not the whole texts."""

    def cut(start: str, end: str) -> Column:
        a, b = (F.col(c).bitwiseAND(0xFFFFFFFF).cast("int") for c in (start, end))
        return F.substring(F.col("text").cast("binary"), a + 1, b - a)

    mine = pairs.join(texts, ["doc_id", "tag"]).withColumn("part", cut("start", "end")).drop("text", "end")
    firsts = texts.withColumnsRenamed({"doc_id": "origin", "tag": "o_tag"})
    both = mine.join(firsts, ["origin", "o_tag"]).withColumn("first_part", cut("o_start", "o_end"))
    both = both.select("doc_id", "tag", "origin", F.shiftright("start", 32).alias("start"), "part", "first_part")
    return both.mapInArrow(_near_rows(min_words), "doc_id long, tag long, origin long, places array<int>")


def _open_windows(shared: DataFrame, marks: DataFrame, scratch: Scratch, min_words: int) -> DataFrame:
    """The joint windows of the keys of live ones (whose minima lie in no passage of the later text found so far), a row for each text in a group: all keys with one first document.

    (group, doc_id, tag, shingles first to after, keys, live_keys)
    """
    marked = marks.select("doc_id", "tag", F.arrays_zip("starts", "ends").alias("marks"))
    live = shared.where("first < doc_id").join(marked, ["doc_id", "tag"], "left")
    live = live.where("not coalesce(exists(marks, x -> x.starts <= at and at < x.ends), false)").drop("marks")
    live = scratch.save(live)
    keys = live.groupBy("key").agg(F.lit(True).alias("wanted"))
    met = shared.join(keys, "key", "left_semi")  # the live windows and all they may be compared with
    flags = live.select("doc_id", "tag", "key", "start", "at", F.lit(True).alias("live"))
    met = met.join(flags, ["doc_id", "tag", "key", "start", "at"], "left").withColumn("live", F.coalesce("live", F.lit(False)))
    windows = met.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("key", "start", "end", "at", "live")).alias("windows"))
    joint = scratch.save(windows.mapInArrow(_joint_rows(min_words), "doc_id long, tag long, live boolean, key long, first int, after int"))
    wanted = joint.groupBy("key").agg(F.max("live").alias("any"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    wanted = scratch.save(wanted.where("any and a < b").select("key", F.col("a").alias("group")))  # written: a plain input, so that a hot key is split
    keys = F.collect_set("key").alias("keys"), F.collect_set(F.when(F.col("live"), F.col("key"))).alias("live_keys")
    found = joint.join(wanted, "key").groupBy("group", "doc_id", "tag").agg(F.min("first").alias("first"), F.max("after").alias("after"), *keys)
    found = scratch.save(found)
    scratch.drop(live, joint)
    return found


def _part_rows(min_words: int):
    """The ranges of a text that go to blocks, each with the blocks it is dealt to, the hashes of its shingles and bits for those in passages found before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "text"):
            words, _, _, at_word = X.word_table([t.translate(X.SPACE_FOLD) for t in X.text_bytes(batch.column("text"))])
            shingles, at = X.shingle_table(words, at_word, WIDTH, short=False)
            short = (shingles >> np.uint64(32)).astype(np.uint32)
            done = np.zeros(len(short), bool)
            for k, (starts, ends) in enumerate(zip(batch.column("starts").to_pylist(), batch.column("ends").to_pylist())):
                for a, b in zip(starts or (), ends or ()):
                    done[at[k] + a : at[k] + b - WIDTH + 1] = True
            ranges = batch.column("ranges")
            w = ranges.flatten()
            source = np.repeat(np.arange(batch.num_rows), pc.list_value_length(ranges).to_numpy())
            places = [(at[k] + a, at[k] + b) for k, a, b in zip(source, w.field("first").to_numpy(), w.field("after").to_numpy())]
            named = {n: w.field(n) for n in ("group", "blocks", "first", "keys", "live_keys")} | {n: batch.column(n).take(pa.array(source)) for n in ("doc_id", "tag")}
            bits = {"shingles": [short[a:b].tobytes() for a, b in places], "done": [np.packbits(done[a:b]).tobytes() for a, b in places]}
            yield pa.RecordBatch.from_pydict(named | {n: pa.array(x, pa.binary()) for n, x in bits.items()})

    return run


def membership(rows: list[np.ndarray], entries: np.ndarray) -> np.ndarray:
    """A row for each of rows with 1 where it holds the entry (sorted, distinct), as bytes."""
    table = np.zeros((len(rows), len(entries)), np.uint8)
    value, row = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = np.minimum(np.searchsorted(entries, value), len(entries) - 1)
    hit = entries[at] == value
    table[row[hit], at[hit]] = 1
    return table


def common_counts(one: np.ndarray, other: np.ndarray, width: int = 4096) -> np.ndarray:
    """How many entries the rows of two tables share, by matrix products of `width` entries at a time."""
    total = np.zeros((len(one), len(other)), np.float32)
    for a in range(0, one.shape[1], width):
        total += one[:, a : a + width].astype(np.float32) @ other[:, a : a + width].astype(np.float32).T
    return total.astype(np.int32)


def in_several(parts: list[np.ndarray], doc: np.ndarray) -> np.ndarray:
    """The entries, sorted and distinct, that occur in parts of two documents or more."""
    value = np.concatenate(parts)
    order = np.argsort(value, kind="stable")
    value, of = value[order], np.repeat(doc, [len(p) for p in parts])[order]
    if not len(value):
        return value
    head = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    return value[head][np.minimum.reduceat(of, head) < np.maximum.reduceat(of, head)]


def places_table(rows: list[np.ndarray], entries: np.ndarray) -> np.ndarray:
    """A row for each of rows with the place, from 1, of each entry (sorted, distinct), or 0."""
    table = np.zeros((len(rows), len(entries)), np.int32)
    sizes = np.array([len(r) for r in rows])
    value, row = np.concatenate(rows), np.repeat(np.arange(len(rows)), sizes)
    at = np.minimum(np.searchsorted(entries, value), len(entries) - 1)
    hit = entries[at] == value
    table[row[hit], at[hit]] = (np.arange(len(value)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1)[hit]
    return table


def hold_once(rows: list[np.ndarray]) -> np.ndarray:
    """Which of rows of 32-bit entries hold none twice."""
    once = np.ones(len(rows), bool)
    coded = np.repeat(np.arange(len(rows), dtype=np.uint64) << np.uint64(32), [len(r) for r in rows]) | np.concatenate([np.zeros(0, np.uint32), *rows])
    coded.sort()
    once[coded[1:][coded[1:] == coded[:-1]] >> np.uint64(32)] = False
    return once


def may_reach(held: np.ndarray, least: int, theirs: np.ndarray | None = None, lone: np.ndarray | None = None) -> np.ndarray:
    """Which places of mine may lie in a near-duplicate range, for each partner.

    held has a row for each partner with the places of mine that it shares. theirs
    are those shingles' places in the partner, if no side holds one twice: a range
    from place s to place t of mine then shares no more than lies between them.
    Else lone are the places of mine whose shingle comes once: each that is not
    held lies outside the common set. In both cases the similarity is bounded by a
    term of t less a term of s, so the best of each before and after a place tell.
    """
    n = held.shape[1]
    if n < least:
        return np.zeros(held.shape, bool)
    if theirs is not None:
        rate = (100 + PERCENT) * np.cumsum(held, axis=1, dtype=np.int64) - PERCENT * (np.arange(n) + theirs)
        before, after = rate - (100 + PERCENT), rate - 2 * PERCENT
    else:
        step = np.where(held, 100 - PERCENT, np.where(lone, -PERCENT, 0))
        after = np.cumsum(step, axis=1, dtype=np.int64)
        before = after - step
    far = np.int64(1) << np.int64(60)
    from_here = np.minimum.accumulate(np.where(held, before, far), axis=1)
    to_here = np.maximum.accumulate(np.where(held, after, -far)[:, ::-1], axis=1)[:, ::-1]
    some = (to_here[:, least - 1 :] >= from_here[:, : n - least + 1]).any(1)
    return (to_here >= from_here) & some[:, None]


def open_ranges(theirs: np.ndarray, done: np.ndarray, least: int) -> list[tuple[int, int]]:
    """The near-duplicate ranges of mine, as near_spans has them, that hold places which are not done; they are done then.

    theirs says where the partner holds each shingle of mine, from 1, or 0; no side holds one twice.
    """
    to = np.flatnonzero(theirs)
    other = theirs[to] - 1
    head = np.flatnonzero(np.concatenate([[True], (np.diff(to) != 1) | (np.diff(other) != 1)]))
    sizes = np.diff(np.append(head, len(to)))
    from_a, from_b = other[head], to[head]
    to_a, to_b = from_a + sizes, from_b + sizes
    left = np.concatenate([[0], np.cumsum(~done)])
    found = []
    n, all_runs = len(head), np.arange(len(head))
    step = max(1, RUN_CELLS // n)
    for first in range(0, n, step):
        s = all_runs[first : first + step, None]
        total = to_a - from_a[s] + to_b - from_b[s]
        within = np.cumsum(np.where((from_a >= from_a[s]) & (all_runs >= s), sizes, 0), axis=1)
        good = (to_a - from_a[s] >= least) & (to_b - from_b[s] >= least) & (left[to_b] > left[from_b[s]]) & ((100 + PERCENT) * within >= PERCENT * total)
        at, ends = np.nonzero(good[:, ::-1])
        for s, t in zip((at + first).tolist(), (n - 1 - ends).tolist()):
            j, q = int(from_b[s]), int(to_b[t])
            if done[j:q].all():
                continue
            inside = from_a[s : t + 1]
            both = int(sizes[s : t + 1][(inside >= from_a[s]) & (inside < to_a[t])].sum())
            if (100 + PERCENT) * both >= PERCENT * int(to_a[t] - from_a[s] + q - j):
                done[j:q] = True
                found.append((j, q))
    return found


def open_passages(
    mine: np.ndarray, spans: Callable, places: Callable, single: bool, plain: np.ndarray, counts: np.ndarray, least: int, done: np.ndarray
) -> list[tuple[int, int, int]]:
    """(shingle from, to, which partner) of near-duplicate ranges of mine, the fullest partner first.

    spans(which) verifies one partner by near_spans; places(which) has a row for each
    partner with where it holds each shingle of mine, from 1, or 0; single says
    whether mine holds none twice, plain which partners do so. Partners are taken in
    stages of growing size, and one is tried as long as a place that is not done may
    lie in a range of both. done is brought up to date.
    """
    lone = None
    order = np.argsort(-counts, kind="stable")
    found: list[tuple[int, int, int]] = []
    at, size = 0, STAGE
    while at < len(order) and not done.all():
        stage = order[at : at + size]
        at, size = at + size, 8 * size
        theirs = places(stage)
        held = theirs > 0
        twice = ~plain[stage] if single else np.ones(len(stage), bool)
        reach = may_reach(held, least, theirs)
        if twice.any():
            if lone is None:
                _, which, times = np.unique(mine, return_inverse=True, return_counts=True)
                lone = times[which] == 1
            reach[twice] = may_reach(held[twice], least, lone=lone)
        for row in np.flatnonzero((reach & ~done).any(1)).tolist():
            if not (reach[row] & ~done).any():
                continue
            k = int(stage[row])
            if not twice[row]:
                found.extend((p, q, k) for p, q in open_ranges(theirs[row], done, least))
                continue
            for p, q in spans(k):
                if not done[p:q].all():
                    done[p:q] = True
                    found.append((p, q, k))
    return found


def _block_rows(min_words: int):
    """Near-duplicate passages of the ranges of one block or pair of blocks: in each group, of texts that are mine with those that are theirs and share a key that is live in mine."""
    least = min_words - WIDTH + 1

    def run(table: pa.Table) -> pa.Table:
        group, doc, tag, start, role = (table.column(c).to_numpy() for c in ("group", "doc_id", "tag", "first", "role"))
        parts = [np.frombuffer(b, np.uint32) for b in table.column("shingles").to_pylist()]
        done = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(p)).astype(bool) for b, p in zip(table.column("done").to_pylist(), parts)]
        keys, live_keys = ([np.array(x, np.int64) for x in table.column(c).to_pylist()] for c in ("keys", "live_keys"))
        once = hold_once(parts)
        rows, places, origins = [], [], []
        order = np.lexsort((tag, doc, group))
        cuts = np.flatnonzero(np.diff(group[order])) + 1
        for members in np.split(order, cuts):
            later, earlier = (members[role[members] & bit > 0] for bit in (MINE, THEIRS))
            later = later[[len(live_keys[i]) > 0 and not done[i].all() for i in later]] if len(later) else later
            if not len(later) or not len(earlier):
                continue
            both = in_several([parts[i] for i in members], doc[members])
            met = np.unique(np.concatenate([live_keys[i] for i in later]))
            step = max(1, TABLE_BYTES // max(1, 5 * len(both) + len(met)))
            for b in range(0, len(earlier) if len(both) else 0, step):
                theirs = earlier[b : b + step]
                where = places_table([parts[i] for i in theirs], both)
                held, with_key = (where > 0).view(np.uint8), membership([keys[i] for i in theirs], met)
                for a in range(0, len(later), 256):
                    mine = later[a : a + 256]
                    counts = common_counts(membership([parts[i] for i in mine], both), held)
                    may = ((100 + PERCENT) * counts >= 2 * PERCENT * least) & (doc[theirs] < doc[mine][:, None])
                    may &= common_counts(membership([live_keys[i] for i in mine], met), with_key) > 0
                    for r in np.flatnonzero(may.any(1)):
                        i, ok = mine[r], np.flatnonzero(may[r])
                        at = np.minimum(np.searchsorted(both, parts[i]), len(both) - 1)
                        common = both[at] == parts[i]
                        theirs_of = lambda which, ok=ok, at=at, common=common, where=where: where[np.ix_(ok[which], at)] * common
                        spans = lambda k, i=i, ok=ok, theirs=theirs: near_spans(parts[theirs[ok[k]]], parts[i], least)
                        for p, q, k in open_passages(parts[i], spans, theirs_of, once[i], once[theirs[ok]], counts[r, ok], least, done[i]):
                            rows.append(i)
                            places.append([p + int(start[i]), q - p - least + 1])
                            origins.append(doc[theirs[ok[k]]])
        at = np.array(rows, np.int64)
        return pa.table({"doc_id": pa.array(doc[at]), "tag": pa.array(tag[at]), "origin": pa.array(origins, pa.int64()), "places": pa.array(places, pa.list_(pa.int32()))})

    return run


def _block_passages(ranges: DataFrame, marks: DataFrame, texts: DataFrame, scratch: Scratch, min_words: int) -> DataFrame:
    """Near-duplicate passages, beyond the marks, of texts with earlier ones that share a live key.

    Groups that fit one block share tasks with others; those of more are dealt to
    pairs of blocks: a range goes to its block of all ranges once for each block
    of live ones, and a live one to its block of those once for each block of all.
    """
    live = F.size("live_keys") > 0
    size = (F.col("after") - F.col("first")) * 4
    sizes = ranges.groupBy("group").agg(F.sum(size).alias("bytes"), F.sum(F.when(live, size)).alias("live_bytes")).where("live_bytes > 0")
    sizes = scratch.save(sizes)
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    blocks = {n: F.ceil(F.col(c) / BLOCK_BYTES).cast("int") for n, c in (("all", "bytes"), ("open", "live_bytes"))}
    sizes = sizes.select("group", *(c.alias(n) for n, c in blocks.items()))

    def block(low: Column | int, high: Column | int, role: Column | int) -> Column:
        as_column = lambda x, kind: (F.lit(x) if isinstance(x, int) else x).cast(kind)
        return F.struct(as_column(low, "long").alias("low"), as_column(high, "int").alias("high"), as_column(role, "int").alias("role"))

    alone = block(F.pmod(F.xxhash64("group"), F.lit(total // BLOCK_BYTES + 1)), -1, F.when(live, MINE + THEIRS).otherwise(THEIRS))
    own = {n: F.pmod(F.xxhash64("doc_id", F.lit(n)), F.col(n)) for n in ("all", "open")}
    as_theirs = F.transform(F.sequence(F.lit(0), F.col("open") - 1), lambda j: block(own["all"], j, THEIRS))
    as_mine = F.transform(F.sequence(F.lit(0), F.col("all") - 1), lambda i: block(i, own["open"], MINE))
    dealt = F.when(F.col("all") == 1, F.array(alone)).when(live, F.concat(as_theirs, as_mine)).otherwise(as_theirs)
    dealt = ranges.join(sizes, "group").select("doc_id", "tag", F.struct("group", "first", "after", "keys", "live_keys", dealt.alias("blocks")).alias("r"), "all")
    dealt = dealt.groupBy("doc_id", "tag").agg(F.collect_list("r").alias("ranges")).join(marks.drop("origins"), ["doc_id", "tag"], "left")
    kinds = "group long, blocks array<struct<low:long,high:int,role:int>>, first int, keys array<long>, live_keys array<long>, doc_id long, tag long, shingles binary, done binary"
    parts = texts.join(dealt, ["doc_id", "tag"]).mapInArrow(_part_rows(min_words), kinds)
    parts = parts.withColumn("b", F.explode("blocks")).drop("blocks").select("*", "b.*").drop("b")
    task = F.when(F.col("high") >= 0, F.col("group"))  # pairs of blocks of one group; groups of one block by their number
    found = parts.groupBy(task.alias("task"), "low", "high").applyInArrow(_block_rows(min_words), "doc_id long, tag long, origin long, places array<int>")
    return scratch.save(found)


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, tag, whole, starts, ends, origins) of the texts with repeats, by merged word range.

    tag is xxhash64 of the text, so texts that share a doc_id are told apart;
    whole marks a copy of another document's text; an origin is the least
    document found for a part of the range.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "substrings")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    texts = texts.withColumn("tag", F.xxhash64("text"))
    base = scratch.save(texts.mapInArrow(_window_rows(min_words), _BASE_ROW))
    if not base.groupBy("doc_id", "tag").count().where("count > 1").isEmpty():  # rows that repeat id and text count once
        texts = texts.dropDuplicates(["doc_id", "tag"])
        base = scratch.save(base.dropDuplicates(["doc_id", "tag"]))
    classes = base.where(F.col("n_words") >= min_words).groupBy("hi", "lo").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    # Written, so that the joins below have plain inputs: small ones are broadcast, skewed ones split.
    classes = scratch.save(classes.where("least < most").select("hi", "lo", "least"))
    copies = scratch.save(base.join(classes, ["hi", "lo"]).where("doc_id > least").select("doc_id", "tag", "least", "n_words"))
    # One document stands for its whole copies.
    postings = base.join(copies.select("doc_id", "tag"), ["doc_id", "tag"], "left_anti")
    postings = postings.select("doc_id", "tag", F.explode(F.arrays_zip("key", "start", "end", "at")).alias("w")).select("doc_id", "tag", "w.*")
    keys = postings.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    keys = scratch.save(keys.where("first < last").select("key", "first", "n"))
    shared = scratch.save(postings.join(keys, "key"))
    scratch.drop(keys, base)
    candidates = shared.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("key", "start", "end")).alias("windows"))
    rows = texts.join(candidates, ["doc_id", "tag"]).mapInArrow(_run_rows(min_words), "doc_id long, tag long, run long, places array<int>")
    rows = scratch.save(rows)
    earliest = rows.groupBy("run").agg(F.min("doc_id").alias("origin"), F.max("doc_id").alias("last")).where("origin < last")
    earliest = scratch.save(earliest.select("run", "origin"))
    found = rows.join(earliest, "run").where(F.col("doc_id") > F.col("origin")).select("doc_id", "tag", "places", "origin")
    pairs = scratch.save(_first_pairs(shared, scratch))
    near = scratch.save(_verified(pairs, texts, min_words))
    marks = scratch.save(_merged(found.unionByName(near), min_words))
    scratch.drop(rows, earliest, pairs, near)
    joint = _open_windows(shared, marks, scratch, min_words)
    scratch.drop(shared)
    near = _block_passages(joint, marks, texts, scratch, min_words)
    spans = _merged(_unmerged(marks, min_words).unionByName(near), min_words).withColumn("whole", F.lit(False))
    every = copies.select("doc_id", "tag", _range(F.lit(0), F.col("n_words").cast("int"), min_words), F.col("least").alias("origin"))
    spans = scratch.save(spans.unionByName(_merged(every, min_words).withColumn("whole", F.lit(True))))
    scratch.clear(spans)
    return spans


def _range(start: Column, end: Column, min_words: int) -> Column:
    return F.array(start, end - start - min_words + 1).alias("places")


def _unmerged(marks: DataFrame, min_words: int) -> DataFrame:
    """Merged ranges as rows with places, to be merged with others."""
    rows = marks.select("doc_id", "tag", F.explode(F.arrays_zip("starts", "ends", "origins")).alias("s"))
    return rows.select("doc_id", "tag", _range(F.col("s.starts"), F.col("s.ends"), min_words), F.col("s.origins").alias("origin"))


def merge_ranges(row: np.ndarray, start: np.ndarray, end: np.ndarray, origin: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of a row that overlap or touch as one, with the least origin; by row and start."""
    if not len(row):
        return row, start, end, origin
    order = np.lexsort((start, row))
    row, start, end, origin = (x[order] for x in (row, start, end, origin))
    shift = row * (np.int64(1) << np.int64(32))  # ranges of different rows never touch
    reach = np.maximum.accumulate(end + shift)
    head = np.flatnonzero(np.concatenate([[True], (start + shift)[1:] > reach[:-1]]))
    return row[head], start[head], np.maximum.reduceat(end, head), np.minimum.reduceat(origin, head)


def _merged(spans: DataFrame, min_words: int) -> DataFrame:
    """One row a text of rows with places and origin."""
    rows = spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("places", "origin")).alias("spans"))
    return rows.mapInArrow(_merged_rows(min_words), "doc_id long, tag long, starts array<int>, ends array<int>, origins array<long>")


def _merged_rows(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            spans = batch.column("spans").flatten()
            of_row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column("spans")).to_numpy())
            runs = pc.list_value_length(spans.field("places")).to_numpy() // 2
            origin = np.repeat(spans.field("origin").to_numpy(), runs)
            places = spans.field("places").flatten().to_numpy().astype(np.int64).reshape(-1, 2)
            first, start, end, origin = merge_ranges(np.repeat(of_row, runs), places[:, 0], places.sum(1) - 1 + min_words, origin)
            cuts = np.searchsorted(first, np.arange(batch.num_rows + 1))
            columns = (X.list_array(c, cuts, t) for c, t in ((start, pa.int32()), (end, pa.int32()), (origin, pa.int64())))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), *columns], names=["doc_id", "tag", "starts", "ends", "origins"])

    return run


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, start, end, n_words, origin_id: one row per passage that repeats an earlier document; no others."""
    spans = repeated_spans(docs, min_words)
    rows = spans.select("doc_id", F.explode(F.arrays_zip("starts", "ends", "origins")).alias("s"))
    return rows.select(
        "doc_id",
        F.col("s.starts").alias("start"),
        F.col("s.ends").alias("end"),
        (F.col("s.ends") - F.col("s.starts")).alias("n_words"),
        F.col("s.origins").alias("origin_id"),
    )


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the merged spans and the white space before them."""
    raw = text.encode()
    inside = np.frombuffer(b" " + raw.translate(X.SPACE_FOLD) + b" ", np.uint8) != 32
    turn = np.diff(inside.astype(np.int8))
    end = np.flatnonzero(turn == -1)
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at : int(end[a - 1]) if a else 0])
        at = int(end[b - 1])
    out.append(raw[at:])
    return b"".join(out).decode()


def _cut_rows(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            ranges = zip(batch.column("__llm_starts").to_pylist(), batch.column("__llm_ends").to_pylist())
            kept = np.ones(len(texts), bool)
            for i, (starts, ends) in enumerate(ranges):
                if starts:
                    texts[i] = cut_words(texts[i], list(zip(starts, ends)))
                    kept[i] = bool(texts[i].strip())
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(kept))

    return run


def cut_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with repeated passages cut from text (and n_chars, if there, set anew); documents left without words go."""
    spans = repeated_spans(docs, min_words)
    marks = spans.select(*(F.col(c).alias(f"__llm_{c}") for c in ("doc_id", "tag", "whole", "starts", "ends")))
    same = (docs["doc_id"].cast("long") == marks["__llm_doc_id"]) & (F.xxhash64(docs["text"].cast("string")) == marks["__llm_tag"])
    rows = docs.join(marks, same, "left").where("not coalesce(__llm_whole, false)")
    out = rows.drop("__llm_doc_id", "__llm_tag", "__llm_whole").mapInArrow(_cut_rows(docs.columns), docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast(kind))
    return out
