"""Page normalisation: MDX, JSX and HTML to plain Markdown.

The rules are data: (pattern, replacement) pairs that both engines read. Rules
that need no state are Column chains (`html_to_markdown`, `strip_imports`, ...);
`normalize_page` applies all rules in order in one Arrow batch function, because
four of them (tabs, wrappers, braces outside code, nested components) loop.

Kept as they are, since they shape the text: brace-only lines and `{name}` go
inside fenced code too, and tag patterns match by prefix (`<p...>` hits `<pre>`).
Front matter is put back literally, whatever `$` it holds.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

Rule = tuple[str, str]  # Java / Python pattern, replacement with \1 for groups

# Patterns of each rule set, in the order they apply.
IMPORTS: tuple[Rule, ...] = (
    (r"(?m)^import\s+.*?(?:from\s+['\"][^'\"]*['\"])?;?\s*$", ""),
    (r"(?m)^import\s*\{[^}]*\}\s*from\s*['\"][^'\"]*['\"];?\s*$", ""),
    (r"(?m)^export\s+(?:default\s+)?(?:const|let|var|function|class)\s+[\s\S]*?(?=\n(?:import|export|#|\n|$))", ""),
    (r"(?m)^export\s+\{[^}]*\};?\s*$", ""),
    (r"(?m)^export\s+default\s+.*?;?\s*$", ""),
)
PRESENTATIONAL = ("MainImage", "NextPage", "WasPageHelpful", "Image", "Video", "ApiRequest", "ApiResponse")
WRAPPERS = ("Row", "Portion", "Card", "Text", "Badge")
HTML_TAGS = (
    "p", "div", "span", "u", "pre", "ul", "ol", "li", "h1", "h2", "h3", "h4", "h5", "h6",
    "table", "thead", "tbody", "tr", "th", "td", "blockquote", "details", "summary",
)
PARAGRAPH_TAGS = frozenset({"p", "tr", "table", "div", "blockquote", "details"})
INLINE_HTML: tuple[Rule, ...] = (
    (r"(?i)<hr[^>]*/?>", "\n---\n"),
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)<img\s+src=[\"']([^\"']+)[\"'][^>]*/?>", r"![](\1)"),
    (r"(?i)</img>", ""),
    (r"(?i)<a\s+href=[\"']([^\"']+)[\"'][^>]*>([^<]*)</a>", r"\2 (\1)"),
    (r"(?i)<(?:strong|b)[^>]*>([\s\S]*?)</(?:strong|b)>", r"**\1**"),
    (r"(?i)<(?:em|i)[^>]*>([\s\S]*?)</(?:em|i)>", r"*\1*"),
    (r"(?i)<code>([^<]+)</code>", r"`\1`"),
)
SPACERS: tuple[Rule, ...] = (
    (r"\{\s*[\"']\s*[\"']\s*\}", " "),
    (r"\{/\*[\s\S]*?\*/\}", ""),
    (r"\{[a-zA-Z_][a-zA-Z0-9_]*\}", ""),
)
LINE_BRACES: tuple[Rule, ...] = ((r"\{[^}`]*=>[^}`]*\}", ""), (r"\{(?![^}]*[\"'`:]\s*[{\[])[^}`]+\}", ""))
DIRECTIVES: tuple[Rule, ...] = ((r"(?m)^:::.*$", ""),)
LINK: Rule = (r"(?<!!)\[([^\]]+)\]\(([^)]+)\)", r"\1 (\2)")
BEFORE_LINES: tuple[Rule, ...] = (
    (r"(?m)^\s+$", ""),
    (r"\n{4,}", "\n\n\n"),
    (r"className=[\"'][^\"']*[\"']", ""),
    (r"class=[\"'][^\"']*[\"']", ""),
)
AFTER_LINES: tuple[Rule, ...] = (
    (r"\),\s*\},", ""),
    (r"\]\s*\}\s*>", ""),
    (r">\s*\n\s*<", "\n"),
    (r"(?m)^\s*\{\s*$", ""),
    (r"(?m)^\s*key:\s*[\"'][^\"']*[\"'],?\s*$", ""),
    (r"(?m)^\s*label:\s*[\"'][^\"']*[\"'],?\s*$", ""),
    (r"(?m)^\s*content:\s*\(\s*$", ""),
    (r"(?m)^\s*/>\s*$", ""),
    (r"(?m)^\s*</>\s*$", ""),
    (r"(?m)^\s*\(\s*$", ""),
    (r"(?m)^\s*\)\s*$", ""),
    (r"(?m)^\s*[,;:)}\]]+\s*$", ""),
)
FRONT_MATTER = r"^---\n([\s\S]*?)\n---\n?"
CODE_COMPONENT = r"<CodeBlockWithCopy\s+language=[\"']([^\"']+)[\"']>\s*\{\s*`\s*([\s\S]*?)\s*`\s*\}\s*</CodeBlockWithCopy>"
CALLOUT = r"<Callout\s+type=[\"'][^\"']+[\"']>\s*([\s\S]*?)\s*</Callout>"
LOOP_LIMIT, NESTING_LIMIT = 100, 20
TAB_CODE_CHARS = 10


def presentational_rules() -> tuple[Rule, ...]:
    return tuple(r for n in PRESENTATIONAL for r in ((f"<{n}[^>]*/>", ""), (rf"<{n}[^>]*>[\s\S]*?</{n}>", "")))


def html_rules() -> tuple[Rule, ...]:
    closing = lambda t: "\n" if t == "li" else "\n\n" if t in PARAGRAPH_TAGS else ""
    tags = (r for t in HTML_TAGS for r in ((f"(?i)<{t}[^>]*>", "- " if t == "li" else ""), (f"(?i)</{t}>", closing(t))))
    return (*INLINE_HTML, *tags)


# --- Column chains ---------------------------------------------------------


def apply_rules(c: Column, rules: tuple[Rule, ...]) -> Column:
    return reduce(lambda x, r: F.regexp_replace(x, r[0], re.sub(r"\\(\d)", r"$\1", r[1])), rules, c)


def strip_imports(c: Column) -> Column:
    return apply_rules(c, IMPORTS)


def strip_presentational(c: Column) -> Column:
    return apply_rules(c, presentational_rules())


def html_to_markdown(c: Column) -> Column:
    return apply_rules(c, html_rules())


def convert_front_matter(c: Column) -> Column:
    yaml = F.regexp_extract(c, FRONT_MATTER, 1)
    rest = F.regexp_replace(c, FRONT_MATTER, "")
    return F.when(c.rlike(FRONT_MATTER), F.concat(F.lit("Metadata\n"), F.regexp_replace(yaml, r"^\s+|\s+$", ""), F.lit("\n\n"), rest)).otherwise(c)


def convert_links(c: Column) -> Column:
    """[text](url) to text (url); images and fenced code stay."""
    fences = F.regexp_extract_all(c, F.lit("(?s)```.*?```"), F.lit(0))
    pieces = F.transform(F.split(c, "(?s)```.*?```", -1), lambda p: apply_rules(p, (LINK,)))
    return F.array_join(F.flatten(F.transform(pieces, lambda p, i: F.array(p, F.coalesce(F.get(fences, i), F.lit(""))))), "")


def strip_html_description(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", ""), r"^\s+|\s+$", "")


# --- the whole chain, one text ---------------------------------------------


def _rules(text: str, rules: tuple[Rule, ...]) -> str:
    return reduce(lambda t, r: re.sub(r[0], r[1], t), rules, text)


def _flat(inner: str, spacer: bool) -> str:
    """Markup without tags and braces, on one line."""
    text = re.sub(r"<[^>]+>", " ", inner)
    text = _rules(text, SPACERS[:1]) if spacer else text
    return re.sub(r"\s+", " ", re.sub(r"\{[^}]*\}", "", text)).strip()


def _callouts(text: str) -> str:
    def note(m: re.Match) -> str:
        flat = _flat(m[1], spacer=True)
        return f"\n**Note:** {flat}\n" if flat else ""

    return re.sub(CALLOUT, note, text)


def _tabs_body(markup: str) -> str:
    codes = [c for c in (m.strip() for m in re.findall(r"\{\s*`([\s\S]*?)`\s*\}", markup)) if len(c) > TAB_CODE_CHARS]
    labels = re.findall(r"label:\s*[\"']([^\"']+)[\"']", markup)
    out = []
    for i in range(max(len(codes), len(labels))):
        out += [f"\n#### {x}\n" for x in labels[i : i + 1]] + [f"\n```\n{x}\n```\n" for x in codes[i : i + 1]]
    return "".join(out)


def _tabs(text: str) -> str:
    for _ in range(LOOP_LIMIT):
        start = text.find("<Tabs")
        if start < 0:
            break
        ends = [(text.find(mark, start), len(mark)) for mark in ("</Tabs>", "/>", ">")]
        stop = next((at + size for at, size in ends if at >= 0), None)
        if stop is None:
            break
        text = text[:start] + _tabs_body(text[start:stop]) + text[stop:]
    return text


def _unwrap(text: str, tag: str) -> str:
    for _ in range(LOOP_LIMIT):
        start = text.find("<" + tag)
        end = text.find(">", start) if start >= 0 else -1
        if end < 0:
            break
        head, rest = text[:start], text[end + 1 :]
        if text[end - 1] == "/":
            text = head + rest
            continue
        inner, close, tail = rest.partition(f"</{tag}>")
        text = f"{head}\n\n{inner}\n\n{tail}" if close else head + rest
    return text


def _braces(text: str) -> str:
    """Expressions in braces, on lines outside fenced code."""
    out, fenced = [], False
    for line in _rules(text, SPACERS).split("\n"):
        mark = line.strip().startswith("```")
        fenced ^= mark
        out.append(line if mark or fenced else _rules(line, LINE_BRACES))
    return "\n".join(out)


def _components(text: str) -> str:
    text = re.sub(r"<[A-Z][a-zA-Z]*[^>]*/>", "", text).replace("<>", "").replace("</>", "")
    for _ in range(NESTING_LIMIT):
        flat = re.sub(r"<([A-Z][a-zA-Z]*)[^>]*>([\s\S]*?)</\1>", lambda m: _flat(m[2], spacer=False), text)
        if flat == text:
            break
        text = flat
    return text


def _links(text: str) -> str:
    return "".join(p if i % 2 else re.sub(*LINK, p) for i, p in enumerate(re.split(r"(```[\s\S]*?```)", text)))


def _line(line: str) -> str:
    return line.rstrip() if re.match(r"\s+[-*\d]|\s{4,}", line) else line.strip()


def _cleanup(text: str) -> str:
    text = "\n".join(map(_line, _rules(text, BEFORE_LINES).split("\n")))
    return _rules(text, AFTER_LINES).strip()


def _front_matter(text: str) -> str:
    m = re.match(FRONT_MATTER, text)
    return f"Metadata\n{m[1].strip()}\n\n{text[m.end():]}" if m else text


STEPS: tuple[Callable[[str], str], ...] = (
    lambda t: _rules(t, IMPORTS),
    _front_matter,
    lambda t: re.sub(CODE_COMPONENT, "\n```\\1\n\\2\n```\n", t),
    _callouts,
    lambda t: _rules(t, presentational_rules()),
    _tabs,
    lambda t: reduce(_unwrap, WRAPPERS, t),
    lambda t: _rules(t, html_rules()),
    _braces,
    _components,
    lambda t: _rules(t, DIRECTIVES),
    _links,
    _cleanup,
)


def normalize_text(text: str) -> str:
    return reduce(lambda t, step: step(t), STEPS, text)


@F.pandas_udf(StringType())
def normalize_page(pages: pd.Series) -> pd.Series:
    """All rules in order; null stays null."""
    return pages.map(normalize_text, na_action="ignore")
