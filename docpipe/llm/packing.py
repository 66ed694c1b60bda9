"""Best-fit packing of documents into sequences of at most L tokens, in bulk.

Tokenising (whole texts, exact ids) gives one small row a piece. Sizes are whole
numbers up to L, so documents and gaps are range-sorted into at most L size
classes each, whatever the input. One sweep goes through the document classes
from large to small; its successor step finds the smallest class of gaps that
fits, gives as many documents as there are gaps (or gaps as documents) at once,
moves those gaps to their new class, and repeats; what fits nowhere opens new
sequences. That is best-fit decreasing; its cost depends on the number of
classes, not on that of documents. The outcome is a table of runs: documents of
one size with ranks [from, to) take consecutive sequences at one offset.

Ranks are computed by distributed windows over (size, slot) and counts of those;
a slot is the hash of a row number that is written with the pieces, and there
are as many slots as the most frequent size needs, so neither one size nor equal
rows meet in one task. Conflicts for one gap cannot arise as each rank has its
own place in a run. Full pieces are sequences by themselves and need no rank.

Defined cases: null text is the empty text, which is the end token alone; a null
doc_id is packed too; repeated rows are packed once each; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from . import _text as X
from ._store import Scratch

LENGTH = 2048
END = 0
SLOT_ROWS = 65_536  # of one size that are ranked in one task, on average
CACHE_WORDS = 600_000

_STOPS = frozenset((b".", b",", b";", b":", b"!", b"?"))


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free code point from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in plain)}


class WordTokens:
    """Ids of texts from the ids of their blank-separated words.

    The vocabulary's pre-tokeniser drops white space and never joins across it,
    so the ids of a text are those of its words in order; words repeat, so most
    are looked up. A new word that is a run of lower-case letters is one
    pre-token and goes to the BPE model directly; a stop after such a run is a
    pre-token of its own; any other word takes the whole tokenizer. The table of
    words is emptied when it is full.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.special = {t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.known: dict[bytes, bytes] = {}
        self.raw = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]  # an id as it is joined

    def _run_of_letters(self, word: bytes) -> bytes | None:
        """Ids of a word that is one pre-token as it stands, else None; ASCII letters are lower-case already."""
        if word.isalpha():
            text = word.decode()
        else:
            text = word.decode()
            if not text.isalpha() or text.lower() != text or not unicodedata.is_normalized("NFC", text):
                return None
            text = "".join([self.letters[b] for b in word])
        return b"".join([self.raw[t.id] for t in self.model.tokenize(text)])

    def learn(self, words: list[bytes]) -> None:
        known, hard = self.known, []
        self._whole([s for s in _STOPS if s not in known])
        for w in words:
            core = w.lower()
            stop = core[-1:]
            if stop in _STOPS and len(core) > 1:
                core = core[:-1]
            else:
                stop = b""
            # What the table holds for a run of letters may be used for it with a stop or in capitals.
            ids = known.get(core) if core.isalpha() else None
            if ids is None:
                ids = self._run_of_letters(core) if core not in self.special else None
                if ids is None:
                    hard.append(w)
                    continue
                known[core] = ids
            known[w] = ids + known[stop] if stop else ids
        self._whole(hard)

    def _whole(self, words: list[bytes]) -> None:
        for a in range(0, len(words), 4096):
            part = words[a : a + 4096]
            found = self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            self.known.update((w, b"".join([self.raw[i] for i in e.ids])) for w, e in zip(part, found))

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for text in texts:
            words = text.split()
            known = self.known
            if len(known) > CACHE_WORDS:
                known.clear()
            found = list(map(known.get, words))
            if None in found:
                self.learn(list(dict.fromkeys(w for w, ids in zip(words, found) if ids is None)))
                found = map(known.__getitem__, words)
            yield b"".join(found)


_loaded: dict[str, WordTokens] = X.cache("packing")


def _piece_rows(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        end = np.array([END], np.uint32).tobytes()
        for batch in X.slices(batches, "text", keeps="packing"):
            if path not in _loaded:
                _loaded[path] = WordTokens(path)
            source, piece, start, size, crc = [], [], [], [], []
            for i, ids in enumerate(_loaded[path].ids(X.text_bytes(batch.column("text")))):
                ids += end
                for k, a in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[a : a + 4 * length]
                    source.append(i)
                    piece.append(k)
                    start.append(a // 4)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(source, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: documents as tokens, cut only if longer than length."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_piece_rows(tokenizer_path, length), "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_runs(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (size, from rank, to rank, first sequence, documents a sequence, offset).

    Rank r of a run lies in sequence first + (r - from) // each, at offset +
    ((r - from) % each) * size.
    """
    runs = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> ranges of sequences that have it
    order: list[int] = []  # the gaps that occur, sorted
    opened = 0

    def put(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                bisect.insort(order, gap)
                gaps[gap] = []
            gaps[gap].append((first, n))

    for size in sorted((s for s, n in counts.items() if n > 0), reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect.bisect_left(order, size)
            if at == len(order):
                break
            gap = order[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[at]
            # While the remainder is the best fit for the next document too, it is filled at once.
            each = gap // size
            use = min(n, left // each)
            if not use:
                use, each = 1, left
            runs.append((size, rank, rank + use * each, first, each, length - gap))
            rank, left = rank + use * each, left - use * each
            put(gap - each * size, first, use)
            put(gap, first + use, n - use)
        if left:
            each = length // size
            whole, rest = divmod(left, each)
            for use, k in ((whole, each), (1, rest)):
                if use and k:
                    runs.append((size, rank, rank + use * k, opened, k, 0))
                    rank += use * k
                    put(length - k * size, opened, use)
                    opened += use
    return runs


def _place_rows(runs: list[tuple[int, int, int, int, int, int]]):
    table = np.array(sorted(runs), np.int64).reshape(-1, 6)
    shift = np.int64(1) << np.int64(44)  # size and rank as one key

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[:, 0] * shift + table[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            size, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            r = table[np.searchsorted(keys, size * shift + rank, side="right") - 1]
            step = rank - r[:, 1]
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(r[:, 3] + step // r[:, 4]), pa.array(r[:, 5] + step % r[:, 4] * size)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """pieces with sequence_id and offset; no sequence holds more than length tokens.

    pieces: doc_id, piece, start, length, ids_crc32 and row, a number that stays with
    its row however often the table is read.
    """
    spark = pieces.sparkSession
    ship(spark)
    # At most `length` totals reach the driver.
    totals = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if totals and max(totals) > length:
        raise ValueError(f"a piece has {max(totals)} tokens, a sequence {length}")
    totals.pop(length, None)
    full = pieces.where(F.col("length") == length).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    slots = 1 + max(totals.values(), default=0) // SLOT_ROWS
    keyed = pieces.where(F.col("length") < length).withColumn("slot", F.pmod(F.xxhash64("row"), F.lit(slots)))
    counted = keyed.groupBy("length", "slot").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    base = counted.select("length", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "slot").orderBy("row")
    ranked = keyed.withColumn("place", F.row_number().over(inside) - 1).join(base, ["length", "slot"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("place")).alias("rank"))
    placed = ranked.mapInArrow(
        _place_rows(best_fit_runs(totals, length)),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
    return placed.unionByName(full)


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """Tokenise and pack docs (doc_id, text)."""
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = token_pieces(docs, tokenizer_path, length).withColumn("row", F.monotonically_increasing_id())
    return pack(scratch.save(pieces), length)
