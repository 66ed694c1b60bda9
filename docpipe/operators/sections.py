"""Markdown blocks and the heading tree as flat rows.

Blocks are read by functions.mdblocks and their words by functions.mdinline, so
sections hold text without item marks, quote marks, delimiter rows, tags, emphasis
marks or link targets. Each block below the root lands in the section of the last
heading before it; text before the first heading belongs to the first section, and
a document without headings has none. A code block that occurred before in the
document is left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.mdblocks import Node, blocks, label_of
from ..functions.mdinline import plain_inline
from ..shipping import ship

SECTION_SCHEMA = "doc_path string, seq int, level int, heading string, section_path array<string>, content string"

FRONT_MATTER = re.compile(r"\A---[ \t]*\r?\n(.*?)(?:\r?\n)?---[ \t]*(?:\r?\n|\Z)", re.S)


def targets_of(nodes: list[Node]) -> dict[str, str]:
    """Definitions of a page by label; the first of equal labels holds."""
    found: dict[str, str] = {}
    for n in nodes:
        if n.kind == "definition":
            found.setdefault(label_of(n.text or ""), n.info or "")
    return found


def html_words(text: str) -> str:
    """HTML lines without tags; lines without anything else go."""
    return "\n".join(x for x in (re.sub(r"<[^>]*>", "", x).rstrip() for x in text.split("\n")) if x)


def block_texts(body: str) -> Iterator[tuple[Node, str]]:
    """The blocks below the root with their words: without marks, a paragraph, item, row or piece of code a line."""
    nodes = blocks(body)
    targets = targets_of(nodes)
    tops = [i for i, n in enumerate(nodes) if n.parent == 0]
    for a, b in zip(tops, [*tops[1:], len(nodes)]):
        lines: list[str] = []
        for n in nodes[a:b]:
            if n.kind == "row":
                lines.append("")
            elif n.kind == "cell":
                first = nodes[n.parent + 1] is n
                lines[-1] += ("" if first else " ") + plain_inline(n.text, targets)
            elif n.kind in ("paragraph", "heading"):
                lines.append(plain_inline(n.text, targets))
            elif n.kind == "code":
                lines += filter(None, [n.text])
            elif n.kind == "html":
                lines += filter(None, [html_words(n.text or "")])
        yield nodes[a], "---" if nodes[a].kind == "break" else "\n".join(lines)


def sections(body: str) -> list[dict]:
    """Sections in document order, with the path of headings above each."""
    found: list[dict] = []
    above: list[tuple[int, str]] = []
    early: list[str] = []
    seen: set[str] = set()
    for node, text in block_texts(body):
        if node.kind == "heading":
            above = [a for a in above if a[0] < node.level] + [(node.level, text)]
            found.append({"level": node.level, "heading": text, "section_path": [h for _, h in above], "parts": early})
            early = []
            continue
        if node.kind == "code":
            language = node.info or ""
            key = hashlib.md5(f"{language}:{text.strip()}".encode()).hexdigest()[:8]
            if key in seen:
                continue
            seen.add(key)
            text = f"```{language}\n{text}\n```"
        elif not text.strip():
            continue
        (found[-1]["parts"] if found else early).append(text)
    return [{**{k: s[k] for k in ("level", "heading", "section_path")}, "seq": i, "content": "\n\n".join(s["parts"])} for i, s in enumerate(found)]


def split_front_matter(page: str) -> tuple[dict, str]:
    """(front matter, body); a page whose block is not a YAML mapping keeps it as text."""
    m = FRONT_MATTER.match(page)
    if not m:
        return {}, page
    import yaml

    try:
        data = yaml.safe_load(m[1]) or {}
    except yaml.YAMLError:
        return {}, page
    return (data, page[m.end() :]) if isinstance(data, dict) else ({}, page)


def front_text(value) -> str | None:
    """A YAML scalar as text; null if it is empty or not a scalar."""
    if value is None or isinstance(value, dict | list) or value == "":
        return None
    return str(value).lower() if isinstance(value, bool) else str(value)


def front_values(names: tuple[str, ...]) -> Callable[[Column], Column]:
    """Column -> struct of front matter scalars and the body, read as YAML; only pages that begin with --- are parsed."""

    def run(pages: pd.Series) -> pd.DataFrame:
        found = [split_front_matter(p) if p and p.startswith("---") else ({}, p) for p in pages]
        columns = {n: [front_text(f.get(n)) for f, _ in found] for n in names}
        return pd.DataFrame(columns | {"body": [b for _, b in found]})

    return F.pandas_udf(run, ", ".join(f"{n} string" for n in (*names, "body")))


def _section_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [{"doc_path": p, **s} for p, body in zip(pdf.doc_path, pdf.body) for s in sections(body or "")]
        yield pd.DataFrame(rows, columns=["doc_path", "seq", "level", "heading", "section_path", "content"])


def sections_tree(pages: DataFrame) -> DataFrame:
    """Flat section rows of pages (doc_path, body); map-only."""
    ship(pages.sparkSession)
    return pages.select("doc_path", "body").mapInPandas(_section_rows, SECTION_SCHEMA)


def flat_path(section_path: Column) -> Column:
    return F.array_join(section_path, " > ")


def heading_paths(rows: DataFrame, doc: str = "doc_path", seq: str = "seq", levels: int = 6) -> DataFrame:
    """(doc, seq, section_path) of (doc, seq, level, heading) rows: the headings above each, and its own.

    A heading is above a later one if it is the last of its level or a higher one
    before it, and its level is higher. One window for all levels: linear, and no
    document is held as a whole.
    """
    before = Window.partitionBy(doc).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    entry = F.struct("level", "heading")
    last = rows.withColumns({f"__{k}": F.last(F.when(F.col("level") <= k, entry), ignorenulls=True).over(before) for k in range(1, levels)})
    above = [F.when((F.col(f"__{k}.level") == k) & (F.col("level") > k), F.col(f"__{k}.heading")) for k in range(1, levels)]
    path = F.filter(F.array(*above, F.col("heading")), lambda h: h.isNotNull())
    return last.select(doc, seq, path.alias("section_path"))
