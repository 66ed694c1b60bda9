"""The syntax tree of Markdown pages as a table, and plans over it.

`markdown_tree` is a polymorphic table function: in SQL it stands after LATERAL and
gives a row for each node, in preorder, so that the descendants of a node are a
range of numbers and ancestors are a range join:

    SELECT p.doc_path, t.* FROM pages p, LATERAL markdown_tree(p.text, front => 'title,order') t

    node, last   preorder number, and that of the last descendant
    parent       number of the parent; -1 for the root
    depth        0 for the root
    top          number of the block below the root that the node is in
    leaf, line   number of the block that the node is in, and of its line: the row of a cell, else the block
    kind         of a block (see functions.mdblocks) or of a span (text, code_span, emphasis, strong, delete, link, image, html_span, newline)
    level, info  as of blocks; info is the target of links, images and definitions
    value        text of leaves: code, HTML, break as written; blocks with inline text have it in their spans

With `front`, a constant list of names, the page's front matter is split off as YAML
and its scalars are columns of the root's row (null elsewhere). With `mdx`, indented
lines are no code. A null text gives no rows, an empty one a root.

`page_trees` gives the same trees as arrays, each in the row of its page. What needs
one page at a time (`block_texts`, `block_paths`, `sections_of`) is a plan over such arrays, so text
is neither shuffled nor sorted; a tree of rows is gathered by page first.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..functions import text as T
from ..functions.mdblocks import blocks
from ..functions.mdinline import Span, inlines
from ..scratch import settled
from ..shipping import ship
from .sections import front_text, split_front_matter, targets_of

COLUMNS = {"node": int, "last": int, "parent": int, "depth": int, "top": int, "line": int, "leaf": int, "kind": str, "level": int, "info": str, "value": str}
TREE = StructType([StructField(n, IntegerType() if t is int else StringType()) for n, t in COLUMNS.items()])
INLINE_BLOCKS = ("paragraph", "heading", "cell")
_SPAN_KINDS = {"code": "code_span", "html": "html_span"}


def rows_of(body: str, mdx: bool = False) -> list[list]:
    """The rows of a page's tree."""
    nodes = blocks(body, indented=not mdx)
    targets = targets_of(nodes)
    rows: list[list] = []
    place: list[int] = []  # of each block among the rows

    def add(parent: int, kind: str, level, info, value) -> int:
        at = len(rows)
        depth, top, line, leaf = (rows[parent][3] + 1, *rows[parent][4:7]) if parent >= 0 else (0, at, at, at)
        rows.append([at, at, parent, depth, at if depth == 1 else top, line, leaf, kind, level, info, value])
        return at

    def spans(parent: int, found: list[Span]) -> None:
        for s in found:
            at = add(parent, _SPAN_KINDS.get(s.kind, s.kind), None, s.url, s.value or None)
            spans(at, s.children)

    for n in nodes:
        inline = n.kind in INLINE_BLOCKS
        at = add(place[n.parent] if n.parent >= 0 else -1, n.kind, n.level, n.info, None if inline else n.text)
        rows[at][6] = at
        if n.kind != "cell":  # the cells of a row are one line
            rows[at][5] = at
        place.append(at)
        if inline:
            spans(at, inlines(n.text or "", targets))
    for r in reversed(rows):
        if r[2] >= 0:
            rows[r[2]][1] = max(rows[r[2]][1], r[1])
    return rows


class MarkdownTree:
    """The table function; its columns depend on the constant `front`."""

    @staticmethod
    def analyze(text: AnalyzeArgument, mdx: AnalyzeArgument | None = None, front: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not isinstance(text.dataType, StringType):
            raise ValueError("markdown_tree needs a text")
        for name, arg in (("mdx", mdx), ("front", front)):
            if arg is not None and not arg.isConstantExpression:
                raise ValueError(f"{name} must be a constant")
        names = _names(front.value if front else None)
        if clash := [n for n in names if n in COLUMNS]:
            raise ValueError(f"front matter cannot be named {', '.join(clash)}: that is a column of the tree")
        return AnalyzeResult(StructType([*TREE.fields, *(StructField(n, StringType()) for n in names)]))

    def eval(self, text: str | None, mdx: bool | None = False, front: str | None = None) -> Iterator[tuple]:
        if text is None:
            return
        names, values = _names(front), []
        if names:
            found, text = split_front_matter(text)
            values = [front_text(found.get(n)) for n in names]
        for row in rows_of(text, bool(mdx)):
            yield (*row, *(values if row[0] == 0 else [None] * len(names)))


def _names(front: str | None) -> list[str]:
    return [n.strip() for n in (front or "").split(",") if n.strip()]


def register(spark: SparkSession) -> None:
    """Make markdown_tree known to the session's SQL."""
    ship(spark)
    spark.udtf.register("markdown_tree", F.udtf(MarkdownTree))


def syntax_tree(pages: DataFrame, body: str = "body", mdx: bool = False, front: tuple[str, ...] = ()) -> DataFrame:
    """The other columns of pages, and the tree of each page; map-only."""
    spark = pages.sparkSession
    register(spark)
    keys = [c for c in pages.columns if c != body]
    listed = "".join(f", p.`{k}`" for k in keys).removeprefix(", ")
    args = f"mdx => {str(mdx).lower()}, front => '{','.join(front)}'"
    return spark.sql(f"SELECT {listed}, t.* FROM {{pages}} p, LATERAL markdown_tree(p.`{body}`, {args}) t", pages=pages)


def _tree_batches(body: str, mdx: bool):
    kinds = [pa.int32() if t is int else pa.string() for t in COLUMNS.values()]
    step = 50  # pages whose nodes are held at once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(body)
            batch = batch.filter(batch.column(at).is_valid())
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                nodes: list[list] = []
                ends = [0]
                for text in part.column(at).to_pylist():
                    nodes += rows_of(text, mdx)
                    ends.append(len(nodes))
                fields = [pa.array(c, k) for c, k in zip(zip(*nodes), kinds)]
                trees = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, names=list(COLUMNS)))
                kept = [(n, c) for n, c in zip(part.schema.names, part.columns) if n != body]
                yield pa.RecordBatch.from_arrays([*(c for _, c in kept), trees], names=[*(n for n, _ in kept), "tree"])

    return run


def page_trees(pages: DataFrame, body: str = "body", mdx: bool = False) -> DataFrame:
    """The other columns of pages, and `tree`: the nodes of each page in order, as an array; map-only."""
    ship(pages.sparkSession)
    fields = [f for f in pages.schema.fields if f.name != body]
    return pages.mapInArrow(_tree_batches(body, mdx), StructType([*fields, StructField("tree", ArrayType(TREE))]))


def _nested(tree: DataFrame, key: str) -> DataFrame:
    """(key, tree): whole trees as of page_trees; those of rows are gathered by one aggregate."""
    if "tree" in tree.columns:
        return tree.select(key, "tree")
    return tree.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*COLUMNS))).alias("tree"))


def ancestors(tree: DataFrame, key: str) -> DataFrame:
    """(key, node, above, above_kind) of every node and each node that it lies below: a range join inside a page."""
    below = tree.select(key, "node")
    over = tree.select(F.col(key).alias("__key"), F.col("node").alias("above"), F.col("last").alias("__last"), F.col("kind").alias("above_kind"))
    held = (F.col(key) == F.col("__key")) & (F.col("node") > F.col("above")) & (F.col("node") <= F.col("__last"))
    return below.join(over, held).select(key, "node", "above", "above_kind")


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once for all its places inside other lambdas."""
    return F.transform(F.array(value), use)[0]


def _words(node: Column) -> Column:
    """The words that a node adds to its block, null if it adds none; a cell adds a place in its row."""
    lines = F.transform(F.split(node["value"], "\n"), lambda x: F.regexp_replace(F.regexp_replace(x, "<[^>]*>", ""), r"\s+$", ""))
    html = F.nullif(F.array_join(F.filter(lines, lambda x: x != ""), "\n"), F.lit(""))
    words = F.when(node["kind"] == "cell", "").when(node["kind"] == "html", html).otherwise(node["value"])
    return F.when(~node["kind"].isin("definition", "list"), words)


def _block_arrays(tree: DataFrame, key: str) -> DataFrame:
    """(key, blocks): an array of (top, kind, level, info, text) for each page; see block_texts."""

    def text(nodes: Column) -> Column:
        found = F.filter(F.transform(nodes, lambda n: F.struct(n["line"].alias("line"), n["leaf"].alias("leaf"), _words(n).alias("t"))), lambda n: n["t"].isNotNull())

        def joined(held: Column) -> Column:
            def part(n: Column, i: Column) -> Column:
                before = F.get(held, i - 1)
                between = F.when((i == 0) | (n["leaf"] == before["leaf"]), "").when(n["line"] == before["line"], " ").otherwise("\n")
                return F.concat(between, n["t"])

            return F.array_join(F.transform(held, part), "")

        return _let(found, joined)

    def block(n: Column) -> Column:  # its nodes stand side by side
        nodes = F.slice("tree", n["node"] + 1, n["last"] - n["node"] + 1)
        return F.struct(n["node"].alias("top"), *(n[c].alias(c) for c in ("kind", "level", "info")), F.when(n["kind"] == "break", "---").otherwise(text(nodes)).alias("text"))

    return _nested(tree, key).select(key, F.transform(F.filter("tree", lambda n: n["depth"] == 1), block).alias("blocks"))


def block_texts(tree: DataFrame, key: str) -> DataFrame:
    """(key, top, kind, level, info, text) of the blocks below the root: their words without marks.

    Each paragraph, item, row and piece of code is a line of its own; cells of a
    row are joined by blanks; definitions have no words, and breaks only by
    themselves ("---"). tree: of page_trees, or whole trees as rows.
    """
    return _block_arrays(tree, key).select(key, F.inline("blocks"))


def block_paths(tree: DataFrame, key: str) -> DataFrame:
    """(key, seq, path, level, info, words) of every block in order: the kinds from the root down to it, and the words of a leaf.

    tree: as of block_texts; arrays stay in the rows of their pages, rows are made once.
    """
    nested = _nested(tree, key)
    if "tree" not in tree.columns:
        nested = settled(nested)
    at = lambda i: F.get("tree", i)

    def path(n: Column) -> Column:  # up from parent to parent
        step = lambda s, _: F.struct(at(s["up"])["parent"].alias("up"), F.concat(at(s["up"])["kind"], F.lit(" > "), s["path"]).alias("path"))
        return F.aggregate(F.array_repeat(F.lit(0), n["depth"]), F.struct(n["parent"].alias("up"), n["kind"].alias("path")), step, lambda s: s["path"])

    def words(n: Column) -> Column:  # below a block with inline text there are spans alone
        spans = F.filter(F.slice("tree", n["node"] + 2, n["last"] - n["node"]), lambda x: x["value"].isNotNull())
        text = _let(spans, lambda found: F.when(F.size(found) > 0, F.array_join(F.transform(found, lambda x: x["value"]), "")))
        return F.when(n["kind"].isin(*INLINE_BLOCKS), text).when(~n["kind"].isin("list", "definition"), n["value"])

    def block(n: Column, i: Column) -> Column:
        return F.struct((i + 1).alias("seq"), path(n).alias("path"), n["level"].alias("level"), F.nullif(n["info"], F.lit("")).alias("info"), words(n).alias("words"))

    return nested.select(key, F.inline(F.transform(F.filter("tree", lambda n: n["node"] == n["leaf"]), block)))


def sections_of(tree: DataFrame, key: str) -> DataFrame:
    """(key, seq, level, heading, section_path, content): the sections of each page as a plan over its tree.

    The rules are those of operators.sections: blocks before the first heading
    belong to the first section, equal code counts once a page. tree: as of block_texts.
    """
    heading, code = (lambda b: b["kind"] == "heading"), (lambda b: b["kind"] == "code")
    digest = lambda b: F.when(code(b), T.code_hash8(F.coalesce(b["info"], F.lit("")), b["text"]))
    fenced = lambda b: F.concat(F.lit("```"), F.coalesce(b["info"], F.lit("")), F.lit("\n"), b["text"], F.lit("\n```"))
    rows = _block_arrays(tree, key).select(key, F.filter("blocks", lambda b: b["kind"] != "definition").alias("blocks"))
    rows = rows.withColumns(
        {
            "heads": F.filter(F.transform("blocks", lambda b, i: F.when(heading(b), F.struct(i.alias("at"), b["level"].alias("level"), b["text"].alias("heading")))), lambda h: h.isNotNull()),
            "codes": F.transform("blocks", digest),
        }
    )
    # What a block adds to its section; null if nothing.
    text = lambda b, i: F.when(code(b), F.when(F.array_position("codes", F.get("codes", i)) == i + 1, fenced(b))).when(~heading(b) & (T.trim_ws(b["text"]) != ""), b["text"])
    start = F.struct(F.array().cast("array<struct<level:int,heading:string>>").alias("above"), F.array().cast("array<array<string>>").alias("paths"))

    def step(s: Column, h: Column) -> Column:
        above = F.array_append(F.filter(s["above"], lambda a: a["level"] < h["level"]), F.struct(h["level"].alias("level"), h["heading"].alias("heading")))
        return _let(above, lambda a: F.struct(a.alias("above"), F.array_append(s["paths"], F.transform(a, lambda x: x["heading"])).alias("paths")))

    rows = rows.select(key, "heads", F.transform("blocks", text).alias("texts"), F.aggregate("heads", start, step, lambda s: s["paths"]).alias("paths"))

    def section(h: Column, k: Column) -> Column:
        first = F.when(k == 0, 0).otherwise(h["at"])
        after = F.coalesce(F.get("heads", k + 1)["at"], F.size("texts"))
        content = F.array_join(F.slice("texts", first + 1, after - first), "\n\n")  # leaves out nulls
        return F.struct(k.alias("seq"), h["level"].alias("level"), h["heading"].alias("heading"), F.get("paths", k).alias("section_path"), content.alias("content"))

    return rows.select(key, F.inline(F.transform("heads", section)))
