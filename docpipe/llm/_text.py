"""Shared helpers of the subpackage: Arrow batch walking and 64-bit word hashing.

Everything here is a pure function of its arguments with fixed constants, so a
task that is run again on another executor gives the same bytes.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 256 << 10  # text handled at once inside a Python worker

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

# str.translate / bytes.translate tables: A-Z lowered, the five ASCII control
# spaces (tab to carriage return) turned into a blank; nothing changes length.
SPACE_FOLD = bytes((b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b) for b in range(256))
# The same, and every other ASCII byte that is not a letter or digit is a blank.
ALNUM_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def splitmix(x: np.ndarray) -> np.ndarray:
    """The finaliser of the public-domain SplitMix64 generator, vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    start = np.uint64((salt * 0xD1342543DE82EF95 + 1) & _MASK)
    with np.errstate(over="ignore"):
        return splitmix(start + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


_BYTE_VALUE = seeds(256, 11)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + (1 << 18))
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        if size > 4 * SLICE_BYTES:  # an unusually long text: do not keep its tables
            return tables[0], tables[1]
        _powers[:] = tables
    return _powers[0], _powers[1]


def word_table(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the blank-separated words of some folded texts.

    Returns (hash, start, end, first): per word its 64-bit hash and byte span in
    its own text, and for text i the words first[i]:first[i + 1].
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(sizes + 1, out=at[1:])
    buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8) if texts else np.zeros(0, np.uint8)
    inside = np.empty(len(buf) + 1, np.int8)
    inside[0] = 0
    inside[1:] = buf != 32
    turn = np.diff(inside)
    start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    power, inverse = _power_tables(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[buf] * power[: len(buf)], out=total[1:])
    hashed = splitmix((total[end] - total[start]) * inverse[start])
    first = np.searchsorted(start, at)
    shift = np.repeat(at[:-1], np.diff(first))
    return hashed, start - shift, end - shift, first


def shingle_table(hashed: np.ndarray, first: np.ndarray, width: int, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words inside each text, in order.

    With `short`, a text of fewer words, but not none, gives one hash of its
    whole sequence. Returns (hash, first) in the layout of word_table.
    """
    count = np.diff(first)
    mult = seeds(width, 23)
    n = len(hashed)
    mixed = np.zeros(n, np.uint64)
    for j in range(min(width, n)):
        mixed[: n - j] += hashed[j:] * mult[j]
    full = np.maximum(count - width + 1, 0)
    out_first = np.zeros(len(count) + 1, np.int64)
    brief = (count > 0) & (count < width) & short
    np.cumsum(full + brief, out=out_first[1:])
    keep = np.ones(n, bool)
    for j in range(1, width):  # the last width - 1 words of a text begin no run
        tail = first[1:] - j
        keep[tail[(tail >= first[:-1])]] = False
    out = np.empty(out_first[-1], np.uint64)
    is_brief = np.zeros(len(out), bool)
    is_brief[out_first[:-1][brief]] = True
    out[~is_brief] = splitmix(mixed[keep])
    for i in np.flatnonzero(brief):
        words = hashed[first[i] : first[i + 1]]
        h = np.uint64(len(words))
        for w, m in zip(words, mult):
            h = np.uint64((int(h) * int(m) + int(w)) & _MASK)
        out[out_first[i]] = splitmix(np.array([h], np.uint64))[0]
    return out, out_first


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b if b is not None else b"" for b in column.cast(kind).to_pylist()]


_caches: dict[str, dict] = {}


def cache(name: str) -> dict:
    """A table of this worker that one operator keeps from task to task."""
    return _caches.setdefault(name, {})


def release_others(name: str) -> None:
    """Empty the tables of other operators: a worker serves all of them, one after another."""
    pa.set_memory_pool(pa.system_memory_pool())  # gives freed memory back at once
    held = [c for n, c in _caches.items() if n != name and c]
    for c in held:
        c.clear()
    if held:
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterable[pa.RecordBatch], text_column: str, keeps: str = "") -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about SLICE_BYTES of text, or one row; `keeps` names the caller's cache."""
    release_others(keeps)
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(text_column)).fill_null(0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes + 64) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def list_array(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))
