"""Benchmark decontamination with one Aho-Corasick automaton over normalised windows.

Benchmark questions and answers are normalised as the documents are: A-Z lowered,
words are runs of ASCII letters, digits and non-ASCII characters. Every 10
consecutive words of an item (or all of them, if it has fewer) are a window, and
the windows are the patterns of the automaton. Each document's normalised words
are scanned once; matches are mapped to word ranges and to byte offsets of the
original text.

A benchmark of up to BLOCK_CHARS pattern characters is one automaton. A larger
one has an automaton for each block of items, of which a task holds one at a
time; then the texts are read once against the sorted 64-bit hashes of all
windows (SPOT_WINDOWS of them at a time, 8 bytes each, counted before they are
sent), and only those with an equal hash, which are few, are written and scanned
by the automata. A window in a text always has an equal hash, so no hit is lost,
and the automata decide.

Defined cases: null and empty texts have no words; a null doc_id is kept;
repeated rows are judged alike; an empty benchmark contaminates nothing; items
without words are ignored; a null item_id counts as the text "null"; other
columns are ignored.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from . import _text as X
from ._store import Scratch

WINDOW = 10
BLOCK_CHARS = 2 << 20
SPOT_WINDOWS = 32 << 20

_ROW = "row long, doc_id long, n_words long, starts array<int>, ends array<int>, bytes_from array<int>, bytes_to array<int>, items array<string>"
_automata: dict[str, ahocorasick.Automaton] = X.cache("decontam")


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(X.ALNUM_FOLD).split()


def windows(items: list[tuple[str, bytes]], width: int = WINDOW) -> dict[str, list[str]]:
    """window -> item ids; a window is its words, with a blank before, between and after."""
    found: dict[str, set[str]] = {}
    for item, text in items:
        words = normal_words(text)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            key = (b" " + b" ".join(words[i : i + width]) + b" ").decode("latin-1")
            found.setdefault(key, set()).add(item)
    return {k: sorted(v) for k, v in found.items()}


def _automaton(key: str, shared) -> ahocorasick.Automaton:
    """One automaton per worker and block, built when it is first used."""
    if key not in _automata:
        _automata.clear()
        built = ahocorasick.Automaton()
        for window, items in shared.value.items():
            built.add_word(window, (window.count(" ") - 1, len(window), items))
        built.make_automaton()
        _automata[key] = built
    return _automata[key]


def find_hits(automaton: ahocorasick.Automaton, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
    """(words, merged word ranges inside windows, items) of one text."""
    words = normal_words(text)
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    spans: list[list[int]] = []
    items: set[str] = set()
    at = seen = 0  # blanks before position `at` of the line
    for end, (width, size, names) in automaton.iter(line):
        start = end - size + 1
        if start < at:  # a wider window that began earlier
            first = line.count(" ", 0, start)
        else:
            seen += line.count(" ", at, start)
            at = start
            first = seen
        items.update(names)
        if spans and first <= spans[-1][1] and first >= spans[-1][0]:
            spans[-1][1] = max(spans[-1][1], first + width)
        else:
            spans.append([first, first + width])
    return len(words), merge(spans), items


def merge(spans: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def byte_spans(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte offsets in the original text of word ranges."""
    if not spans:
        return []
    inside = np.frombuffer(b" " + text.translate(X.ALNUM_FOLD) + b" ", np.uint8) != 32
    turn = np.diff(inside.astype(np.int8))
    start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    return [(int(start[a]), int(end[b - 1])) for a, b in spans]


def _hit_rows(shared):
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "text", keeps="decontam"):
            automaton = _automaton(key, shared) if shared is not None else None
            counts, spans, offsets, items = [], [], [], []
            for text in X.text_bytes(batch.column("text")):
                n, found, names = find_hits(automaton, text) if automaton is not None else (len(normal_words(text)), [], ())
                counts.append(n)
                spans.append(found)
                offsets.append(byte_spans(text, found))
                items.append(sorted(names))
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    *(pa.array([[s[k] for s in row] for row in rows], ints) for rows in (spans, offsets) for k in (0, 1)),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=["row", "doc_id", "n_words", "starts", "ends", "bytes_from", "bytes_to", "items"],
            )

    return run


def _blocks(benchmark: DataFrame) -> Iterator[dict[str, list[str]]]:
    """Windows of the benchmark in blocks of bounded size; rows reach the driver one block at a time."""
    block: list[tuple[str, bytes]] = []
    size = 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.col("text").cast("string").alias("text"))
    for row in rows.where("text is not null").toLocalIterator():
        text = row.text.encode()
        if block and size + len(text) * WINDOW > BLOCK_CHARS:
            yield windows(block)
            block, size = [], 0
        block.append((row.item, text))
        size += len(text) * WINDOW
    if block:
        yield windows(block)


def _window_hashes(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` normalised words of each text, in the layout of word_table."""
    words, _, _, first = X.word_table([t.translate(X.ALNUM_FOLD) for t in texts])
    return X.shingle_table(words, first, width, short=False)


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(width, window): the hashes of the windows of benchmark items."""
    for batch in X.slices(batches, "text"):
        widths, hashes = [], []
        texts = X.text_bytes(batch.column("text"))
        for width in range(1, WINDOW + 1):
            part = [t for t in texts if min(len(normal_words(t)), WINDOW) == width]
            found = np.unique(_window_hashes(part, width)[0])
            widths.append(np.full(len(found), width, np.int32))
            hashes.append(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(widths)), pa.array(np.concatenate(hashes).view(np.int64))], names=["width", "window"])


def _spots(benchmark: DataFrame) -> list[dict[int, np.ndarray]]:
    """Sorted window hashes by width, in parts of about SPOT_WINDOWS."""
    texts = benchmark.select(F.col("text").cast("string").alias("text")).where("text is not null")
    found = texts.mapInArrow(_item_rows, "width int, window long").distinct()
    parts = -(-found.count() // SPOT_WINDOWS)
    out = []
    for k in range(parts):
        table = found.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == k).toArrow()
        width, window = table.column("width").to_numpy(), table.column("window").to_numpy().view(np.uint64)
        out.append({int(w): np.sort(window[width == w]) for w in np.unique(width)})
    return out


def _spot_rows(shared, keep: bool | None):
    """Batches with `spotted` (whether a window's hash occurs), or only rows where it is `keep`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "text"):
            texts = X.text_bytes(batch.column("text"))
            hit = np.zeros(len(texts), bool)
            for width, known in shared.value.items():
                hashes, first = _window_hashes(texts, width)
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                equal = np.concatenate([[0], np.cumsum(known[at] == hashes)])
                hit |= equal[first[1:]] > equal[first[:-1]]
            if keep is None:
                hit |= batch.column("spotted").to_numpy(zero_copy_only=False)
                yield batch.set_column(batch.schema.get_field_index("spotted"), "spotted", pa.array(hit))
            else:
                yield batch.filter(pa.array(hit == keep))

    return run


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of docs: n_words, hit word ranges, hit byte ranges of the original, items."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "*")
    blocks = _blocks(benchmark)
    first = next((b for b in blocks if b), None)
    second = next((b for b in blocks if b), None)
    if first is None:
        return numbered.mapInArrow(_hit_rows(None), _ROW)
    if second is None:
        return numbered.mapInArrow(_hit_rows(spark.sparkContext.broadcast(first)), _ROW)
    scratch = Scratch(spark, "decontam")
    spotted = rows.withColumn("spotted", F.lit(False))
    for part in _spots(benchmark):
        spotted = spotted.mapInArrow(_spot_rows(spark.sparkContext.broadcast(part), None), "doc_id long, text string, spotted boolean")
    # Written with its numbers, which are then the same in every scan.
    maybe = scratch.save(spotted.where("spotted").select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"))
    whole = spotted.where("not spotted").select(F.lit(None).cast("long").alias("row"), "doc_id", "text").mapInArrow(_hit_rows(None), _ROW)
    scans = []
    for block in itertools.chain([first, second], blocks):
        if block:
            shared = spark.sparkContext.broadcast(block)
            scans.append(scratch.save(maybe.mapInArrow(_hit_rows(shared), _ROW)))
            shared.destroy()
    hits = scans[0]
    for s in scans[1:]:
        hits = hits.unionAll(s)
    pairs = F.struct(F.col("starts").alias("a"), F.col("ends").alias("b"), F.col("bytes_from").alias("c"), F.col("bytes_to").alias("d"))
    grouped = hits.groupBy("row", "doc_id", "n_words").agg(
        F.collect_list(pairs).alias("p"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    return whole.unionAll(grouped.mapInArrow(_merge_blocks, _ROW))


def _merge_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        columns: list[list] = [[], [], [], []]
        for parts in batch.column("p").to_pylist():
            words = merge([x for p in parts for x in zip(p["a"], p["b"])])
            # Ranges of words that touch are one; so are their bytes.
            joined = []
            for a, b in words:
                inside = [x for x in (y for p in parts for y in zip(p["a"], p["b"], p["c"], p["d"])) if x[0] >= a and x[1] <= b]
                joined.append((min(x[2] for x in inside), max(x[3] for x in inside)))
            for column, values in zip(columns, ([w[0] for w in words], [w[1] for w in words], [j[0] for j in joined], [j[1] for j in joined])):
                column.append(values)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), batch.column("n_words"), *(pa.array(c, pa.list_(pa.int32())) for c in columns), batch.column("items")],
            names=["row", "doc_id", "n_words", "starts", "ends", "bytes_from", "bytes_to", "items"],
        )


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    out = contamination(docs, benchmark)
    hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x)
    return out.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("starts") > 0).alias("contaminated"),
    )


def _clean_rows(shared):
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "text", keeps="decontam"):
            automaton = _automaton(key, shared)
            clean = [not find_hits(automaton, t)[1] for t in X.text_bytes(batch.column("text"))]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that hold no window; no shuffle."""
    spark = docs.sparkSession
    ship(spark)
    blocks = _blocks(benchmark)
    first = next((b for b in blocks if b), None)
    second = next((b for b in blocks if b), None)
    if first is None:
        return docs
    if second is None:
        return docs.mapInArrow(_clean_rows(spark.sparkContext.broadcast(first)), docs.schema)
    scratch = Scratch(spark, "clean")
    clear, maybe = docs, []
    for part in _spots(benchmark):  # what no part spots is clear; what a part is the first to spot is scanned
        shared = spark.sparkContext.broadcast(part)
        maybe.append(clear.mapInArrow(_spot_rows(shared, True), docs.schema))
        clear = clear.mapInArrow(_spot_rows(shared, False), docs.schema)
    left = maybe[0]
    for m in maybe[1:]:
        left = left.unionAll(m)
    left = scratch.save(left)
    for block in itertools.chain([first, second], blocks):
        if block:
            shared = spark.sparkContext.broadcast(block)
            rest = scratch.save(left.mapInArrow(_clean_rows(shared), docs.schema))
            shared.destroy()
            scratch.drop(left)
            left = rest
    return clear.unionAll(left)


CONTAMINATION_SQL = """
WITH lowered AS (
  SELECT 0 AS kind, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 1, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
words AS (
  SELECT kind, id, regexp_extract_all(coalesce(t, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM lowered),
spots AS (
  SELECT kind, id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM words WHERE len(w) > 0),
grams AS (
  SELECT kind, id, i, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g FROM spots),
windows AS (SELECT DISTINCT g, id AS item FROM grams WHERE kind = 1),
short_windows AS (
  SELECT DISTINCT array_to_string(w, ' ') AS g, id AS item, len(w) AS n FROM words WHERE kind = 1 AND len(w) BETWEEN 1 AND 9),
short_spots AS (
  SELECT id, unnest(range(1, len(w) - n + 2)) AS i, n, w FROM words, (SELECT DISTINCT n FROM short_windows) WHERE kind = 0 AND len(w) >= n),
matches AS (
  SELECT d.id, d.i, d.n, x.item FROM grams d JOIN windows x USING (g) WHERE d.kind = 0 AND d.n = 10
  UNION ALL
  SELECT s.id, s.i, s.n, x.item FROM short_spots s JOIN short_windows x ON x.n = s.n AND x.g = array_to_string(s.w[s.i:s.i + s.n - 1], ' ')),
hits AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS p FROM matches) GROUP BY id),
found AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT id, CAST(item AS VARCHAR) AS item FROM matches) GROUP BY id)
SELECT w.id AS doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(f.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hits h USING (id) LEFT JOIN found f USING (id) WHERE w.kind = 0
"""
