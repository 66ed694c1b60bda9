"""Markdown blocks, spans and trees: rules one by one, and the plan over trees against the sequential reader."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from docpipe.functions.mdblocks import blocks
from docpipe.functions.mdinline import inlines, plain_inline
from docpipe.operators import mdtree
from docpipe.operators import sections as S


def shape(text, **more):
    """Blocks as nested text: kind(children) or kind:text."""
    nodes = blocks(text, **more)
    below = {i: [] for i in range(len(nodes))}
    for i, n in enumerate(nodes[1:], 1):
        below[n.parent].append(i)

    def show(i):
        n = nodes[i]
        if below[i]:
            return f"{n.kind}({' '.join(map(show, below[i]))})"
        return n.kind + (f":{n.text}" if n.text is not None else "")

    return " ".join(map(show, below[0]))


BLOCKS = [
    ("text\n- one\n- two", "paragraph:text list(item(paragraph:one) item(paragraph:two))"),
    ("> a\nb\n> c", "quote(paragraph:a\nb\nc)"),
    ("> a\n\nb", "quote(paragraph:a) paragraph:b"),
    ("> - a\n> - b", "quote(list(item(paragraph:a) item(paragraph:b)))"),
    ("> ```\n> x\ny", "quote(code:x) paragraph:y"),
    ("- a\n\n  b\n\n      code\n- c", "list(item(paragraph:a paragraph:b code:code) item(paragraph:c))"),
    ("- a\n  - b\n    - c\n- d", "list(item(paragraph:a list(item(paragraph:b list(item(paragraph:c))))) item(paragraph:d))"),
    ("- a\nlazy\n\nout", "list(item(paragraph:a\nlazy)) paragraph:out"),
    ("1. a\n2) b", "list(item(paragraph:a)) list(item(paragraph:b))"),
    ("text\n2. no item\n1. item", "paragraph:text\n2. no item list(item(paragraph:item))"),
    ("-\n  a\n-\n\n  b", "list(item(paragraph:a) item) paragraph:b"),
    ("* a\n***\n* b", "list(item(paragraph:a)) break list(item(paragraph:b))"),
    ("    a\n\n      b\n\n\nc", "code:a\n\n  b paragraph:c"),
    ("a\n    b", "paragraph:a\nb"),
    ("\tcode\n-\titem\n\n\tmore", "code:code list(item(paragraph:item paragraph:more))"),
    ("```py\n- x\n\n~~~\n```\n~~~\n```\n~~~", "code:- x\n\n~~~ code:```"),
    ("  ```\n   a\n b\n  ```", "code: a\nb"),
    ("```\nopen", "code:open"),
    ("- ```\n  a\n\n  b\n  ```\n- c", "list(item(code:a\n\nb) item(paragraph:c))"),
    ("# a #\n## b\n#no\n####### no", "heading:a heading:b paragraph:#no\n####### no"),
    ("a\nb\n===\nc\n---\n---", "heading:a b heading:c break"),
    ("> a\n---", "quote(paragraph:a) break"),
    ("<div>\n*a*\n\n*b*", "html:<div>\n*a* paragraph:*b*"),
    ("<!-- a\n\nb -->\nc", "html:<!-- a\n\nb --> paragraph:c"),
    ("<pre>\n\na\n</pre>\nb", "html:<pre>\n\na\n</pre> paragraph:b"),
    ("a\n<Card x={1}>\nb", "paragraph:a\n<Card x={1}>\nb"),
    ("<Card x={1}>\nb\n\nc", "html:<Card x={1}>\nb paragraph:c"),
    ("| a | b |\n|---|---|\n| 1 |\n\nc", "table(row(cell:a cell:b) row(cell:1 cell:)) paragraph:c"),
    ("x\na | b\n- | -\nc \\| d | e\n> q", "paragraph:x table(row(cell:a cell:b) row(cell:c | d cell:e)) quote(paragraph:q)"),
    ("a | b\n|-|-|-|", "paragraph:a | b\n|-|-|-|"),
    ("[a]: b\n[c]: <d e> 'f'\ntext", "definition:a definition:c paragraph:text"),
    ("[a]: b", "definition:a"),
    ("", ""),
    ("\n\n \n", ""),
]


@pytest.mark.parametrize("text,want", BLOCKS)
def test_blocks(text, want):
    assert shape(text) == want


def test_pages_without_indented_code():
    assert shape("a\n\n    b", indented=False) == "paragraph:a paragraph:b"


def loose(text):
    return [n.text for n in blocks(text) if n.kind == "list"]


def test_loose_and_tight_lists():
    assert loose("- a\n- b") == ["tight"] and loose("- a\n\n- b") == ["loose"] and loose("- a\n\n  b") == ["loose"]
    assert loose("- a\n  - b\n\n    c\n- d") == ["tight", "loose"]
    assert loose("- a\n- b\n\ntext") == ["tight"]


def kinds(spans):
    """Spans as text: kind(children), or the value."""
    return "".join(s.value if s.kind == "text" else f"<{s.kind}{' ' + s.url if s.url is not None else ''}>{s.value}{kinds(s.children)}</>" for s in spans)


SPANS = [
    ("*a*", "<emphasis>a</>"), ("a * b *", "a * b *"), ("a*b*c", "a<emphasis>b</>c"), ("a_b_c", "a_b_c"), ("_a_b", "_a_b"), ("**a**", "<strong>a</>"),
    ("***a***", "<emphasis><strong>a</></>"), ("**a*", "*<emphasis>a</>"), ("*a **b***", "<emphasis>a <strong>b</></>"), ("*a **b* c**", "<emphasis>a <emphasis><emphasis>b</> c</></>"),
    ("*foo**bar*", "<emphasis>foo**bar</>"), ("**foo*bar**", "<strong>foo*bar</>"), ("*(*a*)*", "<emphasis>(<emphasis>a</>)</>"), ("~~a~~ ~b~", "<delete>a</> <delete>b</>"),
    ("`a`", "<code>a</>"), ("`` a`b ``", "<code>a`b</>"), ("`a*b`*c*", "<code>a*b</><emphasis>c</>"), ("*a`*`", "*a<code>*</>"), ("``a`", "``a`"), ("` `", "<code> </>"),
    ("[a](b)", "<link b>a</>"), ("[a *b*](<c d> \"e\")", "<link c d>a <emphasis>b</></>"), ("![a *b*](c)", "<image c>a <emphasis>b</></>"), ("[a](b(c)d)", "<link b(c)d>a</>"),
    ("[a [b](c) d](e)", "[a <link c>b</> d](e)"), ("[![i](j)](k)", "<link k><image j>i</></>"), ("*[a*](b)", "*<link b>a*</>"), ("[a](b c)", "[a](b c)"), ("[x][Y z]", "<link u>x</>"),
    ("[y  Z][]", "<link u>y  Z</>"), ("[y z]", "<link u>y z</>"), ("[no]", "[no]"), ("\\[a](b)", "[a](b)"), ("<http://a.b/c>", "<link http://a.b/c>http://a.b/c</>"),
    ("<a@b.c>", "<link mailto:a@b.c>a@b.c</>"), ("<b>x</b>", "<html><b></>x<html></b></>"), ("a < b > c", "a < b > c"), ("&lt;&copy;&#65;&nope", "<©A&nope"), ("\\*a\\*", "*a*"),
    ("a\\b", "a\\b"), ("a  \nb", "a<newline>\n</>b"), ("a\\\nb", "a<newline>\n</>b"), ("a \nb", "a\nb"), ("[a]()", "<link >a</>"), ("", ""),
]


@pytest.mark.parametrize("text,want", SPANS)
def test_spans(text, want):
    assert kinds(inlines(text, {"y z": "u"})) == want


def test_marks_in_great_number():
    """Work stays bounded where marks do not pair."""
    for text in ("*a " * 20_000, "a* " * 20_000, "[" * 20_000, "`" * 19 + "`` ` " * 10_000, "![a](" * 5_000, "<" * 20_000, "**x** _y_ " * 5_000, "&" * 20_000):
        assert plain_inline(text) is not None
    assert shape("> " * 300 + "a").count("quote") == 300
    assert shape("- a\n" * 3000).count("item") == 3000


def random_page(seed):
    rng = random.Random(seed)
    inline = lambda: rng.choice(["word", "*em* x", "`co|de`", "[l](u)", "a  \nb", "<b>t</b>", "**s", "![i](j) k", "&amp;", "[r]"])

    def block(depth):
        kind = rng.choice(["p", "p", "h", "h", "h", "code", "list", "quote", "table", "html", "break", "def"] if depth < 3 else ["p", "code"])
        if kind == "h":
            return "#" * rng.randint(1, 4) + " " + inline().replace("\n", " ")
        if kind == "code":
            return rng.choice(["```py\nx = 1\n\ny\n```", "~~~\nz\n~~~", "    ind\n\n    ented", "```\n```"])
        if kind == "list":
            return "\n".join("- " + block(depth + 1).replace("\n", "\n  ") for _ in range(rng.randint(1, 3)))
        if kind == "quote":
            return "> " + "\n\n".join(block(depth + 1) for _ in range(rng.randint(1, 2))).replace("\n", "\n> ")
        if kind == "table":
            return "| a | b |\n|---|---|\n| " + inline().replace("\n", " ").replace("|", "\\|") + " | |"
        return {"html": "<div>\n<i>in</i>\n</div>", "break": "***", "def": "[r]: http://r"}.get(kind) or " ".join(inline() for _ in range(rng.randint(1, 3)))

    return "\n\n".join(block(0) for _ in range(rng.randint(0, 8)))


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(str(i), random_page(i)) for i in range(120)] + [("empty", ""), ("null", None), ("blank", " \n\n")]
    return spark.createDataFrame(rows, "doc_path string, body string").repartition(3)


def test_trees_are_in_preorder(pages):
    rows = mdtree.syntax_tree(pages).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_path, []).append(r)
    assert set(by) == {str(i) for i in range(120)} | {"empty", "blank"}
    above = {(r.doc_path, r.node, r.above) for r in mdtree.ancestors(mdtree.syntax_tree(pages), "doc_path").collect()}
    want = set()
    for path, found in by.items():
        found.sort(key=lambda r: r.node)
        assert [r.node for r in found] == list(range(len(found))) and found[0].kind == "root" and found[0].last == len(found) - 1
        for r in found[1:]:
            p = found[r.parent]
            assert p.node < r.node <= r.last <= p.last and r.depth == p.depth + 1
            assert r.top == (r.node if r.depth == 1 else p.top)
            while p is not None:
                want.add((path, r.node, p.node))
                p = found[p.parent] if p.parent >= 0 else None
    assert above == want


def test_sections_as_a_plan(pages):
    """The plan over the tree gives what the sequential reader gives."""
    key = lambda r: (r.doc_path, r.seq)
    columns = ("doc_path", "seq", "level", "heading", "section_path", "content")
    got = sorted(mdtree.sections_of(mdtree.syntax_tree(pages), "doc_path").select(*columns).collect(), key=key)
    want = sorted(S.sections_tree(pages).select(*columns).collect(), key=key)
    assert len(want) > 100 and got == want


def test_table_function(spark):
    mdtree.register(spark)
    spark.createDataFrame([(1, "---\ntitle: T\norder: 2\nx: [1]\n---\n# H\n"), (2, None), (3, "---\n: bad: [\n---\n")], "id long, text string").createOrReplaceTempView("md_pages")
    found = spark.sql("SELECT p.id, t.* FROM md_pages p, LATERAL markdown_tree(p.text, front => 'title, order,x') t ORDER BY id, node")
    assert found.columns == ["id", *mdtree.COLUMNS, "title", "order", "x"]
    rows = found.collect()
    assert [(r.id, r.kind, r.title, r.order, r.x) for r in rows][:3] == [(1, "root", "T", "2", None), (1, "heading", None, None, None), (1, "text", None, None, None)]
    assert {r.id for r in rows} == {1, 3}
    assert spark.sql("SELECT * FROM markdown_tree('    a', mdx => true)").where("kind = 'code'").isEmpty()
    for bad in ("markdown_tree(1)", "markdown_tree('a', front => 'node')"):
        with pytest.raises(Exception, match="markdown_tree needs a text|column of the tree"):
            spark.sql(f"SELECT * FROM {bad}").collect()


def test_words_of_blocks(spark):
    df = spark.createDataFrame([(1, "- a\n  - *b*\n\n> c\n>\n> d\n\n| x | y |\n|-|-|\n| 1 | |\n")], "id long, body string")
    rows = mdtree.block_texts(mdtree.syntax_tree(df), "id").orderBy("top").select("kind", "text").collect()
    assert [tuple(r) for r in rows] == [("list", "a\nb"), ("quote", "c\nd"), ("table", "x y\n1 ")]
    assert mdtree.block_texts(mdtree.syntax_tree(df.withColumn("body", F.lit(None).cast("string"))), "id").count() == 0


def test_block_paths_read_the_pages_once(spark):
    """The tree is made once, not for each of its uses."""
    tree = mdtree.syntax_tree(spark.createDataFrame([(1, "> - a *b*\n\nc")], "id long, body string"))
    found = mdtree.block_paths(tree, "id")
    assert "PythonUDTF" not in found._jdf.queryExecution().toString()
    assert [(r.path, r.words) for r in found.orderBy("seq").collect()] == [
        ("root", None), ("root > quote", None), ("root > quote > list", None), ("root > quote > list > item", None),
        ("root > quote > list > item > paragraph", "a b"), ("root > paragraph", "c"),
    ]


def test_plans_over_trees_move_no_text(spark, capsys):
    """Sections and words of page_trees: those of the trees as rows and of the sequential reader, without a shuffle or a sort."""
    page = "early\n\n# A\n\n```x\nc\n```\n\n```x\nc \n```\n\n### C\n\n[r]: x\n\n| a | |\n|---|---|\n| 1 | 2 |\n\n## B *e*\n\n<b>\n\n---\n\n- one\n- two\n\n  > three\n"
    bodies = [page, page.replace("#", "\n"), "", None, "# only", "no heading"]
    pages = spark.createDataFrame(list(enumerate(bodies)), "doc_path long, body string")
    nested, flat = mdtree.page_trees(pages), mdtree.syntax_tree(pages)
    assert nested.count() == 5
    for plan in (mdtree.sections_of, mdtree.block_texts):
        found = plan(nested, "doc_path")
        found.explain()
        shown = capsys.readouterr().out
        assert "Exchange" not in shown and "Sort" not in shown
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plan(flat, "doc_path").collect()))
    columns = ("level", "heading", "section_path", "content")
    for i, body in enumerate(bodies):
        got = mdtree.sections_of(nested, "doc_path").where(F.col("doc_path") == i).orderBy("seq").select(*columns).collect()
        assert [tuple(r) for r in got] == [tuple(s[c] for c in columns) for s in S.sections(body or "")]


def test_block_paths_move_no_text(spark, pages, capsys):
    """Paths and words of page_trees: those of the trees as rows and of the block reader, without a shuffle or a sort."""
    found = mdtree.block_paths(mdtree.page_trees(pages), "doc_path")
    found.explain()
    shown = capsys.readouterr().out
    assert shown.count("Exchange") == 1 and "Sort" not in shown and "Join" not in shown  # the one of the pages themselves
    got = sorted(map(tuple, found.collect()), key=lambda r: r[:2])
    assert got == sorted(map(tuple, mdtree.block_paths(mdtree.syntax_tree(pages), "doc_path").collect()), key=lambda r: r[:2])
    want = []
    for r in pages.where("body is not null").collect():
        nodes, paths = blocks(r.body), []
        targets = S.targets_of(nodes)
        for i, n in enumerate(nodes):
            paths.append(f"{paths[n.parent]} > {n.kind}" if n.parent >= 0 else n.kind)
            text = lambda spans: "".join(s.value + text(s.children) for s in spans)
            words = text(inlines(n.text or "", targets)) or None if n.kind in mdtree.INLINE_BLOCKS else None if n.kind in ("list", "definition") else n.text
            want.append((r.doc_path, i + 1, paths[i], n.level, n.info or None, words))
    assert len(want) > 1000 and got == sorted(want, key=lambda r: r[:2])
