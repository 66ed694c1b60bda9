"""Markdown blocks by a stack of open containers.

A line first goes on with the open quotes and list items it belongs to; then it may
begin new containers; what is left goes to a leaf: paragraph, heading, code, HTML,
table, break. Nodes come in preorder: (parent, kind, level, info, text), node 0 is
the root. A text that ends early (an open fence, a list without end) is closed.

    kind        level           info             text
    heading     1 to 6          -                its inline text
    list        first number    mark (- + * . )) "loose" or "tight"
    code        -               language         the code
    definition  -               target           label
    paragraph, html, cell: text; quote, item, table, row, break: nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# Tags whose lines are HTML until a blank line, and tags that run to their end.
HTML_BLOCKS = (
    "address article aside base basefont blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frame frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li link main menu menuitem nav noframes ol optgroup option p param search section "
    "summary table tbody td tfoot th thead title tr track ul"
).split()
HTML_VERBATIM = "pre script style textarea".split()

ATX = re.compile(r" {0,3}(#{1,6})(?:[ \t]+(.*?))?(?:[ \t]+#*)?[ \t]*$")
SETEXT = re.compile(r" {0,3}(=+|-+)[ \t]*$")
FENCE = re.compile(r"( {0,3})(`{3,}|~{3,})[ \t]*([^`]*)$")
BREAK = re.compile(r" {0,3}(?:(?:-[ \t]*){3,}|(?:\*[ \t]*){3,}|(?:_[ \t]*){3,})$")
QUOTE = re.compile(r" {0,3}> ?")
ITEM = re.compile(r"( {0,3})([-+*]|(\d{1,9})([.)]))( +|$)")
DELIMITERS = re.compile(r" {0,3}\|?[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)*\|?[ \t]*$")
DEFINITION = re.compile(r"""[ ]{0,3}\[((?:[^\[\]\\]|\\.)+)\]:\s*(<[^<>\n]*>|[^\s<]\S*)(?:[ \t]*\n?[ \t]+(?:"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|\((?:[^()\\]|\\.)*\)))?[ \t]*(?:\n|$)""")
_FENCES, _UNDERLINES, _BREAKS, _BULLETS = map(frozenset, ("`~", "=-", "-*_", "-+*"))  # first signs of blocks
_SIGNS = _FENCES | _UNDERLINES | _BREAKS | _BULLETS | frozenset("#><|:\t")
_TAKING = frozenset({"code", "html"})  # leaves that may take a line as it is
_PREFIX = re.compile(r"[\s>*+\-\d.)]*")
_VALUE = r"""(?:[^\s"'=<>`]+|'[^']*'|"[^"]*"|\{[^}]*\})"""
OPEN_TAG = rf"<[A-Za-z][\w.:-]*(?:\s+[A-Za-z_:{{][\w.:}}-]*(?:\s*=\s*{_VALUE})?)*\s*/?>"
CLOSE_TAG = r"</[A-Za-z][\w.:-]*\s*>"
_HTML_ENDS: tuple[tuple[re.Pattern, re.Pattern | None], ...] = (
    (re.compile(rf" {{0,3}}<(?:{'|'.join(HTML_VERBATIM)})(?:\s|>|$)", re.I), re.compile(rf"</(?:{'|'.join(HTML_VERBATIM)})>", re.I)),
    (re.compile(r" {0,3}<!--"), re.compile(r"-->")),
    (re.compile(r" {0,3}<\?"), re.compile(r"\?>")),
    (re.compile(r" {0,3}<![A-Za-z]"), re.compile(r">")),
    (re.compile(r" {0,3}<!\[CDATA\["), re.compile(r"\]\]>")),
    (re.compile(rf" {{0,3}}</?(?:{'|'.join(HTML_BLOCKS)})(?:\s|/?>|$)", re.I), None),
    (re.compile(rf" {{0,3}}(?:{OPEN_TAG}|{CLOSE_TAG}|</?>)\s*$"), None),
)


@dataclass(slots=True)
class Node:
    parent: int
    kind: str
    level: int | None = None
    info: str | None = None
    lines: list[str] = field(default_factory=list)

    @property
    def text(self) -> str | None:
        return "\n".join(self.lines) if self.lines else None


@dataclass(slots=True)
class _Frame:
    """An open container; width: the columns that lines of an item are indented by."""

    node: int
    kind: str
    width: int = 0
    mark: str = ""
    blank: bool = False  # a blank line came after its last child


def cells(row: str) -> list[str]:
    """The cells of a table row; an escaped bar is a bar."""
    row = row.strip()
    row = row[1:] if row.startswith("|") else row
    row = row[:-1] if row.endswith("|") and not row.endswith("\\|") else row
    return [c.strip().replace("\\|", "|") for c in re.split(r"(?<!\\)\|", row)]


def label_of(text: str) -> str:
    """A link label in the form in which labels are compared."""
    return " ".join(text.split()).casefold()


class _Reader:
    def __init__(self, indented: bool):
        self.indented = indented
        self.nodes = [Node(-1, "root")]
        self.stack = [_Frame(0, "root")]
        self.leaf: Node | None = None
        self.fence: tuple[str, int] | None = None  # mark and indent of an open fence
        self.html_end: re.Pattern | None = None

    def add(self, kind: str, **more) -> Node:
        """A child of the innermost container; a list ends where no item follows."""
        if kind != "item" and self.stack[-1].kind == "list":
            self.stack.pop()
        top = self.stack[-1]
        if top.blank and top.kind in ("item", "list"):
            of = self.stack[-2] if top.kind == "item" else top
            self.nodes[of.node].lines = ["loose"]
        for f in self.stack:
            f.blank = False
        node = Node(top.node, kind, **more)
        self.nodes.append(node)
        return node

    def push(self, node: Node, **more) -> None:
        self.stack.append(_Frame(len(self.nodes) - 1, node.kind, **more))

    def close(self) -> None:
        """End the open leaf; definitions leave the head of a paragraph."""
        leaf = self.leaf
        if leaf is None:
            return
        self.leaf = self.fence = None
        if leaf.kind == "paragraph":
            self.definitions(leaf)
        elif leaf.kind == "code" and leaf.level:  # indented code ends with its last line that is not blank
            leaf.level = None
            while leaf.lines and not leaf.lines[-1].strip():
                leaf.lines.pop()

    def definitions(self, leaf: Node) -> None:
        if not leaf.lines or not leaf.lines[0].startswith("["):
            return
        text, at = "\n".join(leaf.lines), 0
        while text.startswith("[", at) and (m := DEFINITION.match(text, at)):
            self.nodes.insert(len(self.nodes) - 1, Node(leaf.parent, "definition", None, m[2].strip("<>"), [m[1]]))
            at = m.end()
        if at:
            leaf.lines = text[at:].split("\n") if text[at:].strip() else []
            if not leaf.lines:
                self.nodes.pop()

    def settle(self, matched: int) -> None:
        """A new block begins: close the leaf, and the containers that the line does not go on with."""
        self.close()
        del self.stack[matched:]

    def read(self, raw: str) -> None:
        line = raw
        if "\t" in raw:
            head = _PREFIX.match(raw)[0]
            line = head.expandtabs(4) + raw[len(head) :]
        at, matched = self.containers(line) if len(self.stack) > 1 else (0, 1)
        rest = line[at:]
        blank = not rest or rest.isspace()
        leaf = self.leaf
        if leaf is not None and leaf.kind in _TAKING and matched == len(self.stack) and self.goes_on(raw if len(self.stack) == 1 else line, at, blank):
            return
        if blank:
            self.blank(matched)
            return
        while True:
            new = self.begin(line, at, matched)
            if new is None:
                break
            at, matched = new
            if at < 0:
                return
            rest = line[at:]
            if not rest or rest.isspace():
                return
        text = rest
        if self.leaf is not None and self.leaf.kind == "paragraph":  # also with containers left open: a lazy line
            self.leaf.lines.append(text.strip())
            return
        self.settle(matched)
        self.leaf = self.add("paragraph", lines=[text.strip()])

    def containers(self, line: str) -> tuple[int, int]:
        """(place, number) after the open containers that the line goes on with."""
        at = 0
        for depth, f in enumerate(self.stack):
            if f.kind == "quote":
                m = QUOTE.match(line, at)
                if not m:
                    return at, depth
                at = m.end()
            elif f.kind == "item":
                rest = line[at:]
                pad = len(rest) - len(rest.lstrip(" "))
                if not rest or rest.isspace():
                    if f.node == len(self.nodes) - 1:  # an item that began with a blank line ends with the second
                        return at, depth
                    at = min(at + f.width, len(line))
                elif pad < f.width:
                    return at, depth
                else:
                    at += f.width
        return at, len(self.stack)

    def goes_on(self, line: str, at: int, blank: bool) -> bool:
        """Whether the open leaf takes the line as it is."""
        leaf, text = self.leaf, line[at:]
        if leaf.kind == "code" and self.fence:
            mark, indent = self.fence
            if re.match(rf" {{0,3}}{mark[0]}{{{len(mark)},}}[ \t]*$", text):
                self.close()
            else:
                pad = min(indent, len(text) - len(text.lstrip(" ")))
                leaf.lines.append(text[pad:])
            return True
        if leaf.kind == "code":
            if blank or text.startswith("    "):
                leaf.lines.append(text[4:])
                return True
            return False
        if leaf.kind == "html":
            if blank and self.html_end is None:
                self.close()
                return False
            leaf.lines.append(text)
            if self.html_end and self.html_end.search(text):
                self.close()
            return True
        return False

    def blank(self, matched: int) -> None:
        if matched < len(self.stack) or (self.leaf and self.leaf.kind in ("paragraph", "table")):
            self.settle(matched)
        for f in self.stack:
            f.blank = True

    def begin(self, line: str, at: int, matched: int) -> tuple[int, int] | None:
        """(place, containers) after a block that begins here; place -1 if the line is used up; None if none begins."""
        text = line[at:]
        running = self.leaf if matched == len(self.stack) else None  # a leaf that the line could go on with
        paragraph = running is not None and running.kind == "paragraph"
        if text.startswith("    "):
            lazy = self.leaf is not None and self.leaf.kind == "paragraph"
            if not self.indented or lazy:
                return None
            self.settle(matched)
            self.leaf = self.add("code", level=1, lines=[text[4:]])
            return -1, matched
        text = text.rstrip("\r")
        if running is None or running.kind == "paragraph":
            if text[:1].isalpha():  # begins no block, and is no delimiter row
                return None
        sign = text.lstrip(" ")[:1]  # tells which blocks may begin
        if sign not in _SIGNS and not sign.isdecimal() and (running is None or running.kind != "table"):
            return None
        if sign == ">" and (m := QUOTE.match(text)):
            self.settle(matched)
            self.push(self.add("quote"))
            return at + m.end(), len(self.stack)
        if sign == "#" and (m := ATX.match(text)):
            self.settle(matched)
            self.add("heading", level=len(m[1]), lines=[(m[2] or "").strip()])
            return -1, matched
        if sign in _FENCES and (m := FENCE.match(text)):
            self.settle(matched)
            self.leaf = self.add("code", info=(m[3].split() or [""])[0])
            self.fence = m[2], len(m[1])
            return -1, matched
        for i, (first, end) in enumerate(_HTML_ENDS if sign == "<" else ()):
            if first.match(text) and not (paragraph and i == 6):
                self.settle(matched)
                self.leaf, self.html_end = self.add("html", lines=[text]), end
                if end and end.search(text, first.match(text).end()):
                    self.close()
                return -1, matched
        if paragraph and sign in _UNDERLINES and (m := SETEXT.match(text)):
            self.definitions(running)
            if running.lines:
                running.kind, running.level, running.lines = "heading", 1 if m[1][0] == "=" else 2, [" ".join(running.lines)]
                self.leaf = None
                return -1, matched
            self.leaf = None
            paragraph = False
        if paragraph and "|" in text + running.lines[-1] and DELIMITERS.match(text) and len(cells(text)) == len(cells(running.lines[-1])):
            self.table(running.lines.pop(), running)
            return -1, matched
        if running is not None and running.kind == "table" and not BREAK.match(text) and not ITEM.match(text):
            self.row(text)
            return -1, matched
        if sign in _BREAKS and BREAK.match(text):
            self.settle(matched)
            self.add("break")
            return -1, matched
        if (sign in _BULLETS or sign.isdecimal()) and (m := ITEM.match(text)):
            empty = not text[m.end() :].strip()
            if paragraph and (empty or (m[3] and int(m[3]) != 1)):
                return None
            self.settle(matched)
            mark = m[4] or m[2]
            if self.stack[-1].kind == "list" and self.stack[-1].mark != mark:
                self.stack.pop()
            if self.stack[-1].kind != "list":
                self.push(self.add("list", level=int(m[3]) if m[3] else None, info=mark, lines=["tight"]), mark=mark)
            spaces = len(m[5])
            width = m.end(2) + (1 if empty or spaces > 4 else spaces)
            self.push(self.add("item"), width=width)
            return min(at + width, len(line)), len(self.stack)
        return None

    def table(self, header: str, paragraph: Node) -> None:
        if paragraph.lines:
            self.close()
            node = self.add("table")
        else:
            paragraph.kind, node = "table", paragraph
        self.leaf = node
        self.at = len(self.nodes) - 1
        self.columns = len(cells(header))
        self.row(header)

    def row(self, text: str) -> None:
        """A row has as many cells as the header."""
        row = len(self.nodes)
        self.nodes.append(Node(self.at, "row"))
        found = cells(text)
        for c in (found + [""] * self.columns)[: self.columns]:
            self.nodes.append(Node(row, "cell", lines=[c]))


def blocks(body: str, indented: bool = True) -> list[Node]:
    """The block nodes of a Markdown text; without `indented`, indented lines are no code."""
    reader = _Reader(indented)
    for line in body.replace("\r\n", "\n").split("\n"):
        reader.read(line)
    reader.close()
    return reader.nodes
