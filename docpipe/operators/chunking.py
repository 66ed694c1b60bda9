"""The token-bounded chunker: section texts in, chunks out.

All size decisions go through one accumulator (`Pack`) that re-counts the joined
text on each addition, unless the counter says that its counts add up. A counter
is any text -> int function; the default is the documented regex counter.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field, replace

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..shipping import ship

Count = Callable[[str], int]
_TOKEN = regex.compile(r"\p{L}+|\p{N}{1,3}|[^\s\p{L}\p{N}]")
_FENCE = re.compile(r"```[\s\S]*?```")
_PARAGRAPH = re.compile(r"\n\n+")
_MARK = re.compile(r"__CODE_BLOCK_(\d+)__")


# ASCII bytes by what the counter makes of them: views that keep letters or digits only, and the signs alone.
_BYTES = bytes(range(128))
_LETTERS = bytes(b if bytes((b,)).isalpha() else 32 for b in _BYTES) + b" " * 128
_DIGITS = bytes(b if bytes((b,)).isdigit() else 32 for b in _BYTES) + b" " * 128
_NO_SIGNS = bytes(b for b in _BYTES if chr(b).isalnum() or chr(b) in " \t\n\r\v\f")


def regex_tokens(text: str) -> int:
    """Matches of the token pattern. No token spans a blank: words of ASCII are counted by runs of bytes, others by the pattern."""
    wide = 0
    if text.isascii():
        if text.isalpha():
            return 1
    else:
        words = text.split(" ")
        wide = len(_TOKEN.findall(" ".join(w for w in words if not w.isascii())))
        text = " ".join(w for w in words if w.isascii())
    raw = text.encode()
    digits = raw.translate(_DIGITS).split()
    return wide + len(raw.translate(_LETTERS).split()) + sum((len(d) + 2) // 3 for d in digits) + len(raw.translate(None, _NO_SIGNS))


regex_tokens.additive = True  # no token spans white space, so counts add up over joined parts


@dataclass
class Chunk:
    content: str
    tokens: int
    path: str
    path_array: list[str] = field(default_factory=list)


class Pack:
    """Text under construction and what was emitted of it."""

    def __init__(self, count: Count, joiner: str):
        self.count, self.joiner = count, joiner
        self.additive = getattr(count, "additive", False)
        self.parts: list[str] = []  # joined once, when the text is needed
        self.tokens, self.code = 0, False
        self.out: list[tuple[str, int]] = []

    def add(self, part: str, size: int) -> None:
        """Add a part of `size` tokens by itself; the whole is counted again unless counts add up."""
        if self.parts == [""]:  # nothing so far
            self.parts, self.tokens = [], 0
        self.parts.append(part)
        self.tokens = self.tokens + size if self.additive else self.count(self.joiner.join(self.parts))

    def emit(self) -> None:
        text = self.joiner.join(self.parts)
        if text.strip():
            self.out.append((text.strip(), self.tokens or self.count(text)))
        self.parts, self.tokens, self.code = [], 0, False

    def over(self, more: int, limit: int) -> bool:
        return self.tokens > 0 and self.tokens + more > limit


def _paragraphs(text: str) -> Iterator[tuple[str, bool]]:
    """(paragraph, whether a whole fenced block lies inside it)."""
    fences = [m.span() for m in _FENCE.finditer(text)]
    at = 0
    for part in _PARAGRAPH.split(text):
        start = text.find(part, at)
        at = start + len(part)
        yield part, any(start <= a and b <= at for a, b in fences)


def split_section(text: str, cfg: C.ChunkingConfig, count: Count) -> list[tuple[str, int]]:
    """A section above the maximum, at paragraph borders; code stays with the text before it."""
    parts = list(_paragraphs(text))
    pack = Pack(count, "\n\n")
    for i, (part, code) in enumerate(parts):
        size = count(part)
        introduces = not code and len(part) > C.EXPLANATION_CHARS and i + 1 < len(parts) and "```" in parts[i + 1][0]
        if pack.code and not code and not introduces and pack.tokens > cfg.min_chunk_size:
            pack.emit()
        if code:
            if pack.over(size, cfg.max_chunk_size):
                pack.emit()
            pack.add(part, size)
            pack.code = True
            if pack.tokens >= cfg.min_chunk_size:
                pack.emit()
        else:
            if pack.tokens + size > cfg.max_chunk_size and pack.tokens >= cfg.min_chunk_size:
                pack.emit()
            pack.add(part, size)
            if pack.tokens >= cfg.target_chunk_size and not introduces:
                pack.emit()
    pack.emit()
    return pack.out


def overlap(text: str, cfg: C.ChunkingConfig, count: Count, tokens: int | None = None) -> str:
    """Last sentences of a text (of `tokens`, if they are known), between the overlap sizes; none for short texts."""
    if (count(text) if tokens is None else tokens) < 2 * cfg.min_overlap_size:
        return ""
    taken, total = [], 0
    for sentence in reversed(re.split(r"(?<=[.!?])\s+", text)):
        size = count(sentence)
        if total + size > cfg.max_overlap_size:
            break
        taken.append(sentence)
        total += size
        if total >= cfg.min_overlap_size:
            break
    return " ".join(reversed(taken)).strip()


def merge_small(chunks: list[Chunk], count: Count) -> list[Chunk]:
    """Chunks below the absolute minimum join the one before, else the one after, where the limits allow."""
    additive = getattr(count, "additive", False)

    def joined(a: Chunk, b: Chunk) -> Chunk | None:
        text = f"{a.content}\n\n{b.content}"
        limit = C.MERGE_MAX_CHUNK - (0 if a.path == b.path else C.CROSS_SECTION_ALLOWANCE)
        size = a.tokens + b.tokens if additive else count(text)
        return Chunk(text, size, a.path, a.path_array) if size <= limit else None

    out: list[Chunk] = []
    waiting = list(reversed(chunks))
    while waiting:
        chunk = waiting.pop()
        if chunk.tokens < C.ABSOLUTE_MIN_CHUNK:
            back = joined(out[-1], chunk) if out else None
            if back:
                out[-1] = back
                continue
            ahead = joined(chunk, waiting[-1]) if waiting else None
            if ahead:
                waiting.pop()
                chunk = ahead
        out.append(chunk)
    return out


def sentences(text: str) -> list[str]:
    """Sentences with fenced code kept whole; weaker marks are tried while nothing splits."""
    codes: list[str] = []

    def hide(m: re.Match) -> str:
        codes.append(m[0])
        return f"__CODE_BLOCK_{len(codes) - 1}__"

    hidden = _FENCE.sub(hide, text)
    table = re.search(r"\|[\s-]*---[\s-]*\|", hidden)
    marks = [r"(?<=[.!?])\s+", r"(?<=[;:])\s+", r"(?<=,)\s+"] + ([] if table else [r"\s*\|\s*"])
    parts: list[str] = []
    for mark in marks:
        parts = [p for p in re.split(mark, hidden) if p.strip()]
        if len(parts) > 1:
            break
    return [_MARK.sub(lambda m: codes[int(m[1])] if int(m[1]) < len(codes) else m[0], p) for p in parts]


def _by_sentence(text: str, cfg: C.ChunkingConfig, count: Count) -> list[tuple[str, int]]:
    pack = Pack(count, " ")
    for sentence in sentences(text):
        size = count(sentence)
        if size > C.SENTENCE_SPLIT_ABOVE:
            pack.emit()
            for word in re.split(r"\s+", sentence):
                one = count(word)
                if pack.over(one, cfg.target_chunk_size):
                    pack.emit()
                pack.add(word, one)  # what is left goes on with the next sentence
            continue
        if pack.over(size, cfg.target_chunk_size):
            pack.emit()
        pack.add(sentence, size)
    pack.emit()
    return pack.out


def split_oversized(text: str, tokens: int, cfg: C.ChunkingConfig, count: Count) -> list[tuple[str, int]]:
    """A chunk above the hard maximum; one that is mostly code stays whole."""
    fenced = sum(map(len, _FENCE.findall(text)))
    if re.fullmatch(r"```[\s\S]*?```", text.strip()) or fenced > len(text) * C.CODE_SHARE:
        return [(text, tokens)]
    pack = Pack(count, "\n\n")
    for part, code in _paragraphs(text):
        size = count(part)
        if pack.over(size, C.SOFT_MAX_CHUNK):
            pack.emit()
        pack.add(part, size)
        if (code and pack.tokens >= min(cfg.min_chunk_size, C.SOFT_MAX_CHUNK + 1)) or pack.tokens > C.HARD_MAX_CHUNK * C.APPROACH_SHARE:
            pack.emit()
    pack.emit()
    out: list[tuple[str, int]] = []
    for piece, size in pack.out or [(text, tokens)]:
        out += [(piece, size)] if size <= C.SENTENCE_SPLIT_ABOVE else _by_sentence(piece, cfg, count)
    return out or [(text, tokens)]


def chunk_sections(
    rows: Iterable[tuple[str, list[str], str]], cfg: C.ChunkingConfig | None = None, count: Count = regex_tokens
) -> list[Chunk]:
    """Chunks of one document from (path, path array, content) in order."""
    cfg = cfg or C.ChunkingConfig()
    chunks: list[Chunk] = []
    carried = ""
    for path, path_array, content in rows:
        size = count(content)
        if size <= cfg.max_chunk_size:
            text = f"{carried}\n\n{content}" if carried else content
            chunks.append(Chunk(text.strip(), count(text) if carried else size, path, path_array))
            carried = overlap(content, cfg, count, size)
            continue
        parts = [Chunk(t, n, path, path_array) for t, n in split_section(content, cfg, count)]
        if parts and carried:
            parts[0].content = f"{carried}\n\n{parts[0].content}"
            parts[0].tokens = count(parts[0].content)
        chunks += parts
        carried = overlap(parts[-1].content, cfg, count) if parts else ""
    out: list[Chunk] = []
    for c in merge_small(chunks, count):
        fits = c.tokens <= C.HARD_MAX_CHUNK
        out += [c] if fits else [replace(c, content=t, tokens=n) for t, n in split_oversized(c.content, c.tokens, cfg, count)]
    return out


CHUNKS = "array<struct<chunk_seq:int,section:string,section_path:array<string>,content:string,token_count:int>>"


def chunk_pages(pages: DataFrame, cfg: C.ChunkingConfig | None = None, count: Count = regex_tokens, body: str = "body") -> DataFrame:
    """pages with `chunks`, an array of their chunks, in place of the body: sections are read and packed in one map.

    A page is one row from the scan on, so nothing is shuffled; its other columns stay.
    """
    from .sections import sections

    def rows(text: str | None) -> Iterator[tuple[str, list[str], str]]:
        return ((" > ".join(s["section_path"]), s["section_path"], s["content"]) for s in sections(text or ""))

    return _with_chunks(pages, body, rows, cfg, count)


def chunk_sections_of(pages: DataFrame, cfg: C.ChunkingConfig | None = None, count: Count = regex_tokens) -> DataFrame:
    """As chunk_pages, for pages that have `sections`, an array of (section, section_path, content) in order."""

    def rows(found) -> Iterator[tuple[str, list[str], str]]:
        return ((s["section"], [*s["section_path"]], s["content"]) for s in (found if found is not None else ()) if s["content"] is not None)

    return _with_chunks(pages, "sections", rows, cfg, count)


def _with_chunks(pages: DataFrame, column: str, rows: Callable, cfg: C.ChunkingConfig | None, count: Count) -> DataFrame:
    ship(pages.sparkSession)
    cfg = cfg or C.ChunkingConfig()

    def run(values: pa.Array) -> pa.Array:
        chunks, cuts = [], [0]
        for v in values.to_pylist():
            chunks += enumerate(chunk_sections(rows(v), cfg, count))
            cuts.append(len(chunks))
        columns = {
            "chunk_seq": pa.array([i for i, _ in chunks], pa.int32()),
            "section": pa.array([c.path for _, c in chunks], pa.string()),
            "section_path": pa.array([c.path_array for _, c in chunks], pa.list_(pa.string())),
            "content": pa.array([c.content for _, c in chunks], pa.string()),
            "token_count": pa.array([c.tokens for _, c in chunks], pa.int32()),
        }
        return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(list(columns.values()), names=list(columns)))

    return pages.select(*(c for c in pages.columns if c != column), F.arrow_udf(run, CHUNKS)(F.col(column)).alias("chunks"))


def chunk_documents(rows: DataFrame, cfg: C.ChunkingConfig | None = None, count: Count = regex_tokens) -> DataFrame:
    """Chunks of (doc_path, seq, section, section_path, content) rows; one document is one group.

    Order inside a document decides the result, so a document is the unit of
    work; documents are spread by doc_path, with one shuffle.
    """
    ship(rows.sparkSession)
    rows = rows.where("content is not null")
    section = F.struct(F.col("seq").isNull().alias("last"), "seq", "section", "section_path", "content")
    docs = rows.groupBy("doc_path").agg(F.array_sort(F.collect_list(section)).alias("sections"))
    # Whole batches of documents go to Python: a call for each would cost more than its chunks.
    return chunk_sections_of(docs, cfg, count).select("doc_path", F.inline("chunks"))
