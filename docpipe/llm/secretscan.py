"""Secret scans: fixed patterns, and strings that a token vocabulary cannot shorten.

Words of a language are in a BPE vocabulary as few long pieces; a random string
falls apart into pieces of one or two characters. So each run of key characters
(letters, digits, `+/_=-`, and stops between them) of MIN_CHARS or more is encoded
with a tiktoken vocabulary, and one with at most `ratio` characters a token is a
`random` span. Runs longer than WINDOW are judged window by window; windows that
touch and are random make one span, so no length is left out.

Left out before the test: runs without two of digits, small and capital letters
(words, numbers), hex digests of the usual lengths, UUIDs, algorithm-prefixed
digests (`sha512-...`), bodies of data URIs, and any string in `known` (a set that
the caller bounds; it goes to the executors with the task). Runs that overlap a
pattern span are not judged, as they are found already.

Defined cases: null is the empty text, without spans; a null id is kept; repeated
rows count alike; other columns are ignored. Offsets are code points, end
exclusive, of the whole text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tokens import PATTERN
from ..shipping import ship
from . import _text as X

MIN_CHARS = 20
RATIO = 1.8  # characters a token; random strings of 20 characters and more lie below, words above 2
WINDOW = 128

# The base patterns, in the order of their kinds; what a match needs; the group that is measured.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 8, 2),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 16, 0),
    ("hex", re.compile(r"[0-9a-f]{32,}"), 32, 0),  # equal to the runs of 32 and more among all runs, and faster
)
KINDS = ("assign", "access", "hex", "random")

_RUN = re.compile(r"[A-Za-z0-9+/_=-]+(?:\.[A-Za-z0-9+/_=-]+)*")
_LONG = re.compile(rf"[A-Za-z0-9+/_=.-]{{{MIN_CHARS},}}")
_DIGEST = re.compile(r"(?:(?:md5|sha1|sha224|sha256|sha384|sha512)[-_=/])?(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})|sha(?:1|256|384|512)-[A-Za-z0-9+/]+=*")
_UUID = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}")
_DATA_URI = re.compile(r"data:[\w/+.-]*;base64,\Z")

FOUND = "array<struct<start:int,end:int,kind:string,ratio:double>>"
_encodings: dict = X.cache("secretscan")


def encoding(path: str):
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("supplied", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def base_spans(text: str) -> list[tuple[int, int, str, float | None]]:
    """(start, end, kind, None) of the pattern matches that are long enough."""
    return [(*m.span(), kind, None) for kind, pattern, least, group in BASE for m in pattern.finditer(text) if len(m[group]) >= least]


def mixed(run: str) -> bool:
    """Whether two of digits, small and capital letters occur."""
    return (re.search("[0-9]", run) is not None) + (re.search("[a-z]", run) is not None) + (re.search("[A-Z]", run) is not None) >= 2


def known_form(run: str) -> bool:
    return bool(_DIGEST.fullmatch(run) or _UUID.fullmatch(run))


def random_spans(text: str, vocabulary, taken: list[tuple], ratio: float = RATIO, known: frozenset[str] = frozenset()) -> list[tuple[int, int, str, float]]:
    """(start, end, "random", characters a token) of runs outside the spans in `taken`."""
    found: list[tuple[int, int, str, float]] = []
    edges = sorted((t[0], t[1]) for t in taken)
    at = 0
    reach = 0  # where the taken spans up to `at` end
    for outer in _LONG.finditer(text):
        for m in _RUN.finditer(text, *outer.span()):
            a, b = m.span()
            while at < len(edges) and edges[at][0] < b:
                reach = max(reach, edges[at][1])
                at += 1
            run = m[0]
            if b - a < MIN_CHARS or reach > a or not mixed(run) or known_form(run) or run in known or _DATA_URI.search(text, max(0, a - 80), a):
                continue
            cuts = [*range(0, max(1, len(run) - MIN_CHARS), WINDOW), len(run)]  # a rest under MIN_CHARS goes to the window before it
            parts = [run[i:j] for i, j in zip(cuts, cuts[1:])]
            last: list | None = None
            for i, part, tokens in zip(cuts, parts, vocabulary.encode_ordinary_batch(parts, num_threads=1)):
                if len(part) > ratio * len(tokens) or not mixed(part):
                    last = None
                elif last is None:
                    last = [a + i, a + i + len(part), len(tokens)]
                    found.append(last)
                else:
                    last[1], last[2] = a + i + len(part), last[2] + len(tokens)
    return [(a, b, "random", (b - a) / n) for a, b, n in found]


def text_spans(text: str | None, vocabulary, ratio: float = RATIO, known: frozenset[str] = frozenset()) -> list[tuple[int, int, str, float | None]]:
    """All spans of a text by start, then kind in the order of KINDS, then end."""
    if not text:
        return []
    base = base_spans(text)
    return sorted([*base, *random_spans(text, vocabulary, base, ratio, known)], key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _rows(path: str, ratio: float, known: frozenset[str], mask: bool):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("ratio", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in X.slices(batches, "text", keeps="secretscan"):
            texts = batch.column("text").to_pylist()
            spans = [text_spans(t, encoding(path), ratio, known) for t in texts]
            if mask:
                out, names = [pa.array([t and masked(t, s) for t, s in zip(texts, spans)], pa.string())], ["text"]
            else:
                out, names = [pa.array([[dict(zip(("start", "end", "kind", "ratio"), s)) for s in x] for x in spans], kind)], ["found"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *out], names=["doc_id", *names])

    return run


def masked(text: str, spans: list[tuple]) -> str:
    """The text with each stretch of overlapping spans replaced by the kind of its first one in brackets."""
    out, done = [], 0
    for a, b, kind, _ in spans:
        if a >= done:
            out += [text[done:a], f"[{kind}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def _source(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def secret_spans(docs: DataFrame, vocabulary_path: str, ratio: float = RATIO, known: frozenset[str] = frozenset()) -> DataFrame:
    """doc_id, found: the spans of every text with start, end, kind and, for random ones, characters a token. Map-only."""
    return _source(docs).mapInArrow(_rows(vocabulary_path, ratio, frozenset(known), False), f"doc_id long, found {FOUND}")


def without_secrets(docs: DataFrame, vocabulary_path: str, ratio: float = RATIO, known: frozenset[str] = frozenset()) -> DataFrame:
    """doc_id, text with every span masked; a null text stays null."""
    return _source(docs).mapInArrow(_rows(vocabulary_path, ratio, frozenset(known), True), "doc_id long, text string")


def secret_digest(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Counts of the pattern kinds, the digest of their spans, and all spans as kind:start:end."""
    found = F.col("found")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(found, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return secret_spans(docs, vocabulary_path).select(
        "doc_id",
        *map(count, ("assign", "access", "hex")),
        F.sha2(listed(F.filter(found, lambda s: s.kind != "random")), 256).alias("base_sha256"),
        listed(found).alias("spans"),
        count("random"),
    )
