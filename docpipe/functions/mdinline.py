"""Markdown inline text: escapes, code spans, links, images, HTML and the delimiter runs of emphasis.

`inlines` gives a tree of Span; emphasis follows the delimiter-run rules (left- and
right-flanking runs, multiples of three, underscores not inside words), links bind
tighter than emphasis, code spans tighter than both.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from dataclasses import dataclass, field
from functools import lru_cache

from .mdblocks import CLOSE_TAG, OPEN_TAG, label_of

_SPECIAL = re.compile(r"[\\`*_~\[\]!<&\n]")
_ESCAPED = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_ENTITY = re.compile(r"&(?:#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|[A-Za-z][A-Za-z0-9]*);")
_AUTOLINK = re.compile(r"<([A-Za-z][A-Za-z0-9+.-]{1,31}:[^\s<>]*|[\w.!#$%&'*+/=?^`{|}~-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)>")
_TAG = re.compile(rf"{OPEN_TAG}|{CLOSE_TAG}|<!--[\s\S]*?-->|<\?[\s\S]*?\?>|<![A-Za-z][^>]*>|</?>")
_TITLE = r"""(?:"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|\((?:[^()\\]|\\.)*\))"""
_TARGET = re.compile(rf"\(\s*(?:(<(?:[^<>\n\\]|\\.)*>)|((?:[^\s()\\]|\\.|\((?:[^\s()\\]|\\.)*\))*))(?:\s+{_TITLE})?\s*\)", re.S)
_TICKS = re.compile("`+")
_LABEL = re.compile(r"\[((?:[^\[\]\\]|\\.)*)\]")


@dataclass
class Span:
    """kind: text, code, emphasis, strong, delete, link, image, html, newline; url: the target of a link or image."""

    kind: str
    value: str = ""
    url: str | None = None
    children: list[Span] = field(default_factory=list)


@dataclass
class _Run:
    """A delimiter run that is not used up, or an opening bracket."""

    mark: str
    count: int
    opens: bool
    closes: bool
    size: int = 0  # of the whole run
    at: int = 0  # where the text after a bracket begins
    live: bool = True


def _punctuation(c: str) -> bool:
    return not (c.isalnum() or c.isspace() or c == "_") or c == "_"


def _run(text: str, a: int, b: int) -> _Run:
    """The delimiter run text[a:b] with what it may do."""
    before, after = text[a - 1] if a else " ", text[b] if b < len(text) else " "
    left = not after.isspace() and (not _punctuation(after) or before.isspace() or _punctuation(before))
    right = not before.isspace() and (not _punctuation(before) or after.isspace() or _punctuation(after))
    if text[a] == "_":
        return _Run("_", b - a, left and (not right or _punctuation(before)), right and (not left or _punctuation(after)), b - a)
    return _Run(text[a], b - a, left, right, b - a)


def _unescape(text: str) -> str:
    return _ENTITY.sub(lambda m: html.unescape(m[0]), re.sub(r"\\([!-/:-@\[-`{-~])", r"\1", text))


def _emphasis(pieces: list) -> list[Span]:
    """Pair the delimiter runs of a list of spans and runs; what is left of them is text."""
    floor: dict[tuple, int] = {}  # below it no opener of this kind is left
    c = 0
    while c < len(pieces):
        run = pieces[c]
        if not isinstance(run, _Run) or not run.closes:
            c += 1
            continue
        kind = (run.mark, run.opens, run.size % 3)
        o = c - 1
        while o >= floor.get(kind, 0):
            x = pieces[o]
            if isinstance(x, _Run) and x.opens and x.mark == run.mark:
                thirds = (x.closes or run.opens) and (x.size + run.size) % 3 == 0 and (x.size % 3 or run.size % 3)
                if run.mark == "~" and x.count == run.count <= 2 or run.mark != "~" and not thirds:
                    break
            o -= 1
        if o < floor.get(kind, 0):
            floor[kind] = c
            c += 1
            continue
        used = run.count if run.mark == "~" else min(2, run.count, pieces[o].count)
        name = "delete" if run.mark == "~" else "strong" if used == 2 else "emphasis"
        wrapped = Span(name, children=_texts(pieces[o + 1 : c]))
        pieces[o].count -= used
        run.count -= used
        head = o + (pieces[o].count > 0)
        pieces[head : c + (run.count == 0)] = [wrapped]
        c = head + 1
        floor = {k: min(v, head) for k, v in floor.items()}
    return _texts(pieces)


def _texts(pieces: list) -> list[Span]:
    """Runs as text, neighbouring texts as one."""
    out: list[Span] = []
    for p in pieces:
        span = Span("text", p.mark * p.count if p.mark != "[" else p.mark) if isinstance(p, _Run) else p
        if isinstance(p, _Run) and p.mark == "![":
            span = Span("text", "![")
        if span.kind == "text" and out and out[-1].kind == "text":
            out[-1] = Span("text", out[-1].value + span.value)
        elif span.kind != "text" or span.value:
            out.append(span)
    return out


def inlines(text: str, targets: dict[str, str] | None = None) -> list[Span]:
    """The spans of an inline text; targets: definitions by label_of their label."""
    if not _SPECIAL.search(text):
        return [Span("text", text)] if text else []
    targets = targets or {}
    pieces: list = []
    brackets: list[int] = []  # places in pieces of open brackets
    ticks: dict[int, list[int]] = {}  # starts of backtick runs by size
    for m in _TICKS.finditer(text):
        ticks.setdefault(len(m[0]), []).append(m.start())
    at, n = 0, len(text)

    def put(kind: str, value: str, url: str | None = None, children: list[Span] | None = None) -> None:
        pieces.append(Span(kind, value, url, children or []))

    while at < n:
        m = _SPECIAL.search(text, at)
        stop = m.start() if m else n
        if stop > at:
            put("text", text[at:stop])
            at = stop
            if at == n:
                break
        c = text[at]
        if c == "\\":
            if text[at + 1 : at + 2] == "\n":
                put("newline", "\n")
                at += 2
            elif text[at + 1 : at + 2] in _ESCAPED and at + 1 < n:
                put("text", text[at + 1])
                at += 2
            else:
                put("text", c)
                at += 1
        elif c == "\n":
            hard = False
            if pieces and isinstance(pieces[-1], Span) and pieces[-1].kind == "text":
                hard = pieces[-1].value.endswith("  ")
                pieces[-1] = Span("text", pieces[-1].value.rstrip(" "))
            put("newline" if hard else "text", "\n")
            at += 1
        elif c == "`":
            size = len(_TICKS.match(text, at)[0])
            spots = ticks.get(size, [])
            i = bisect_left(spots, at + size)
            if i == len(spots):
                put("text", "`" * size)
                at += size
            else:
                end = spots[i]
                code = text[at + size : end].replace("\n", " ")
                put("code", code[1:-1] if code.startswith(" ") and code.endswith(" ") and code.strip() else code)
                at = end + size
        elif c in "*_~":
            b = at
            while b < n and text[b] == c:
                b += 1
            pieces.append(_run(text, at, b))
            at = b
        elif c == "&":
            m = _ENTITY.match(text, at)
            put("text", html.unescape(m[0]) if m else c)
            at = m.end() if m else at + 1
        elif c == "<":
            if m := _AUTOLINK.match(text, at):
                put("link", "", ("mailto:" if ":" not in m[1] else "") + m[1], [Span("text", m[1])])
            elif m := _TAG.match(text, at):
                put("html", m[0])
            else:
                put("text", c)
            at = m.end() if m else at + 1
        elif c == "[" or text.startswith("![", at):
            mark = "[" if c == "[" else "!["
            at += len(mark)
            brackets.append(len(pieces))
            pieces.append(_Run(mark, 1, False, False, at=at))
        elif c == "]" and brackets:
            opener = brackets.pop()
            bracket = pieces[opener]
            inside = text[bracket.at : at]
            found = None
            if m := _TARGET.match(text, at + 1):
                found = (m[1][1:-1] if m[1] else m[2]), m.end()
            else:
                m = _LABEL.match(text, at + 1)
                label = label_of(m[1] if m and m[1].strip() else inside)
                if label in targets:
                    found = targets[label], m.end() if m else at + 1
            if found is None or not bracket.live:
                put("text", "]")
                at += 1
                continue
            children = _emphasis(pieces[opener + 1 :])
            del pieces[opener:]
            put("link" if bracket.mark == "[" else "image", "", _unescape(found[0]), children)
            at = found[1]
            if bracket.mark == "[":  # a link holds no other link
                for b in brackets:
                    if pieces[b].mark == "[":
                        pieces[b].live = False
        else:
            put("text", c)
            at += 1
    return _emphasis(pieces)


def plain(spans: list[Span]) -> str:
    """The words of spans without marks; the text of a link, the alternative of an image."""
    return "".join(s.value + plain(s.children) for s in spans)


@lru_cache(maxsize=4096)
def _plain_line(text: str) -> str:
    return plain(inlines(text))


def plain_inline(text: str | None, targets: dict[str, str] | None = None) -> str:
    """The words of an inline text; short lines that depend on no definition come again and again and are kept."""
    text = text or ""
    return plain(inlines(text, targets)) if targets or len(text) > 200 else _plain_line(text)
