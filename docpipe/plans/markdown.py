"""Queries over the syntax trees of pages; each page is made of whole table texts in a known shape."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mdtree, sections
from .catalogue import long, query
from .roundtrips import _LETTERS, SECTIONS_SQL, letters, section_pages, wide

_NESTED = f"WITH RECURSIVE d AS (SELECT doc_id, lang, source, {_LETTERS} AS t, doc_id % 4 + 1 AS k FROM documents)"
_BLOCKS = """
q AS (SELECT doc_id, k, t, 1 AS i, 'root > quote' AS path FROM d UNION ALL SELECT doc_id, k, t, i + 1, path || ' > quote' FROM q WHERE i < k),
b AS (
  SELECT doc_id, 0 AS o, 'root' AS path, CAST(NULL AS INTEGER) AS level, CAST(NULL AS VARCHAR) AS info, CAST(NULL AS VARCHAR) AS words FROM d
  UNION ALL SELECT doc_id, i, path, NULL, NULL, NULL FROM q
  UNION ALL SELECT doc_id, 10, path || ' > paragraph', NULL, NULL, 'said ' || t || chr(10) || 'lazy' FROM q WHERE i = k
  UNION ALL SELECT d.doc_id, x.o, 'root > ' || x.path, x.level, x.info, replace(replace(x.words, '$l', lang), '$t', t) FROM d, (VALUES
    (20, 'list', NULL, '-', NULL), (21, 'list > item', NULL, NULL, NULL), (22, 'list > item > paragraph', NULL, NULL, 'one'),
    (23, 'list > item > list', 3, '.', NULL), (24, 'list > item > list > item', NULL, NULL, NULL), (25, 'list > item > list > item > paragraph', NULL, NULL, 'two'),
    (26, 'list > item > list > item > paragraph', NULL, NULL, 'three $l'), (27, 'list > item > list > item > code', NULL, 'x', '$t' || chr(10) || '  end'),
    (28, 'list > item', NULL, NULL, NULL), (29, 'list > item > quote', NULL, NULL, NULL), (30, 'list > item > quote > heading', 2, NULL, '$t'),
    (31, 'list', NULL, '+', NULL), (32, 'list > item', NULL, NULL, NULL), (33, 'list > item > paragraph', NULL, NULL, '$l'),
    (34, 'paragraph', NULL, NULL, 'text'), (35, 'list', NULL, '-', NULL), (36, 'list > item', NULL, NULL, NULL), (37, 'list > item > paragraph', NULL, NULL, 'cut in'),
    (38, 'break', NULL, NULL, NULL), (39, 'code', NULL, NULL, '$t' || chr(10) || chr(10) || '  kept'), (40, 'table', NULL, NULL, NULL), (41, 'table > row', NULL, NULL, NULL),
    (42, 'table > row > cell', NULL, NULL, 'a'), (43, 'table > row > cell', NULL, NULL, 'b'), (44, 'table > row', NULL, NULL, NULL),
    (45, 'table > row > cell', NULL, NULL, 'x|y'), (46, 'table > row > cell', NULL, NULL, '$t')) AS x(o, path, level, info, words))
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY o) AS INTEGER) AS seq, path, CAST(coalesce(level, 0) AS INTEGER) AS level, info, words FROM b"""


@query(_NESTED + "," + _BLOCKS)
def markdown_blocks(spark, sf_dir):
    """Blocks of nested containers with the kinds above each: quotes of one to four marks, a lazy line, lists in lists, code in items, indented code, a table."""
    t = letters()
    quotes = F.repeat(F.lit("> "), (F.col("doc_id") % 4 + 1).cast("int"))
    body = F.concat(
        quotes, F.lit("said "), t, F.lit("\nlazy\n\n- one\n\n  3. two\n\n     three "), "lang", F.lit("\n     ```x\n     "), t, F.lit("\n       end\n     ```\n- > "), t,
        F.lit("\n  > ---\n+ "), "lang", F.lit("\n\ntext\n- cut in\n***\n    "), t, F.lit("\n\n      kept\n\n| a | b |\n|---|:-:|\n| x\\|y | "), t, F.lit(" |\n"),
    )
    tree = mdtree.page_trees(wide(spark, sf_dir).select("doc_id", body.alias("body")))
    return mdtree.block_paths(tree, "doc_id").withColumn("level", F.coalesce("level", F.lit(0)))


@query(
    f"""SELECT doc_id, t || ' ' || t || lang || ' in ' || t || ' a*b ' || source || ' see ' || lang || ' alt ' || t || ' mark http://a.org/x & * <i>raw</i> old' || chr(10) || 'next' || chr(10) || 'snake_case_name 2 * 3 ref' AS words
    FROM (SELECT *, {_LETTERS} AS t FROM documents)"""
)
def markdown_words(spark, sf_dir):
    """The words of one paragraph with every inline kind: nested emphasis, code, links by target and by definition, an image, escapes, HTML, breaks."""
    t = letters()
    body = F.concat(
        F.lit("*"), t, F.lit(" **"), t, F.lit("***"), F.lit("_"), "lang", F.lit("_ in ***"), t, F.lit("*** `a*b` **"), "source", F.lit("** [see *"), "lang",
        F.lit("*](<http://b.org/a b> \"t\") ![alt "), t, F.lit("](c.png) [mark][R] <http://a.org/x> &amp; \\* <i>raw</i> ~~old~~  \nnext\\\nsnake_case_name 2 * 3 [ref]\n\n[r]: http://r.org\n[ref]: <x> 'title'\n"),
    )
    tree = mdtree.page_trees(wide(spark, sf_dir).select("doc_id", body.alias("body")))
    return mdtree.block_texts(tree, "doc_id").where("kind = 'paragraph'").select("doc_id", F.col("text").alias("words"))


@query(
    """SELECT page_id, kind, CASE kind WHEN 'root' THEN 'page ' || page_id END AS title, CASE kind WHEN 'code' THEN 'html' WHEN 'link' THEN url END AS info,
    CASE kind WHEN 'code' THEN sha256(html) WHEN 'text' THEN sha256('go ' || page_id) END AS value_hash, CAST(n AS BIGINT) AS above
    FROM pages, (VALUES ('root', 0), ('heading', 1), ('link', 2), ('text', 3), ('code', 1)) AS k(kind, n)"""
)
def syntax_tree(spark, sf_dir):
    """Whole pages as trees in SQL: front matter as columns, a link in a heading, the page's HTML as code; and how many nodes lie above each."""
    mdtree.register(spark)
    i = F.col("page_id").cast("string")
    page = F.concat(F.lit("---\ntitle: page "), i, F.lit("\n---\n# [go "), i, F.lit("](<"), "url", F.lit(">)\n~~~~~~~~~~ html\n"), "html", F.lit("\n~~~~~~~~~~\n"))
    pages = wide(spark, sf_dir, "pages").select("page_id", page.alias("text"))
    tree = spark.sql("SELECT p.page_id, t.* FROM {pages} p, LATERAL markdown_tree(p.text, front => 'title') t", pages=pages)
    above = mdtree.ancestors(tree, "page_id").groupBy("page_id", "node").agg(F.count("*").alias("above"))
    rows = tree.join(above, ["page_id", "node"], "left")
    return rows.select("page_id", "kind", "title", "info", F.sha2("value", 256).alias("value_hash"), F.coalesce("above", F.lit(0)).alias("above"))


@query(SECTIONS_SQL)
def tree_sections(spark, sf_dir):
    """The sections of the pages of sections_tree, as a plan over their trees."""
    rows = mdtree.sections_of(mdtree.page_trees(section_pages(spark, sf_dir)), "doc_path")
    return rows.select(long("doc_path").alias("doc_id"), "seq", "level", "heading", sections.flat_path(F.col("section_path")).alias("section"), "content")
