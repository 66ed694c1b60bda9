"""Queries over whole runs of the library: files written and read back, stores, staged syncs, incremental
ingestion, specifications and pages of known shape, each with SQL that says what must come out.

Table rows stand for files, pages and specifications. Where a text must have a
known shape its letters are taken (all other signs become blanks), whole.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import markup as M
from ..functions import text as T
from ..operators import apispec, incremental, ranking, sections, sync, validate
from ..operators.chunking import chunk_documents, chunk_pages
from ..scratch import shared_root
from ..shipping import spread
from ..sources import files, paged, sinks, stores
from ..streaming import incremental as streams
from ..streaming import vectors as vector_streams
from . import pipeline
from .catalogue import _FORCED, _LABEL, CHUNKS_SQL, TOKENS_SQL, chunks, long, previous, query, table, with_cte


def place(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark).rstrip('/')}/docpipe-{name}-{uuid.uuid4().hex}"


def wide(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spread(table(spark, sf_dir, name))


LETTERS = r"regexp_replace(trim(regexp_replace({0}, '[^A-Za-z]+', ' ', 'g')), '^$', 'none')"
_LETTERS = LETTERS.format("text")


def letters(c: str = "text") -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(c, "[^A-Za-z]+", " ")), "^$", "none")


# --- files -----------------------------------------------------------------


@query("SELECT 'site/' || page_id || '.mdx' AS doc_path, sha256(html) AS content_hash FROM pages WHERE page_id % 2 = 0 AND page_id % 7 <> 0")
def read_pages(spark, sf_dir):
    """Pages written as files by the executors, and scanned: other extensions and skipped folders stay out."""
    i = F.col("page_id")
    folder = F.when(i % 7 == 0, "site/node_modules/").otherwise("site/")
    path = F.concat(folder, i.cast("string"), F.when(i % 2 == 0, ".mdx").otherwise(".txt"))
    root = place(spark, "pages")
    sinks.write_files(wide(spark, sf_dir, "pages").select(path.alias("path"), F.col("html").alias("text")), root)
    return files.read_pages(spark, C.ScanConfig(root)).select("doc_path", T.content_hash(F.col("text")).alias("content_hash"))


@query("SELECT lang || '/' || source || '/' || doc_id || '.json' AS path, lang AS category, source || '/' || doc_id AS product, sha256(text) AS content_hash FROM documents")
def spec_paths(spark, sf_dir):
    """Specification files with the category and product of their paths; rows that make no file, as path or text is null, stay rows."""
    i = F.col("doc_id").cast("string")
    path = F.concat("lang", F.lit("/"), "source", F.lit("/"), i, F.lit(".json"))
    docs = table(spark, sf_dir, "documents").select(path.alias("path"), F.col("lang").alias("category"), F.concat("source", F.lit("/"), i).alias("product"), "text")
    root = place(spark, "specs")
    sinks.write_files(docs.where("path is not null and text is not null").select("path", "text"), root)
    specs = files.read_specs(spark, root).unionByName(docs.where("path is null or text is null"))
    return specs.select("path", "category", "product", T.content_hash(F.col("text")).alias("content_hash"))


@query("SELECT page_id || '.md' AS path, 'missing' AS side FROM pages WHERE page_id % 3 = 1 UNION ALL SELECT 'extra.md', 'unexpected'")
def unmatched_files(spark, sf_dir):
    """Pages without an output file, outputs without a page."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.col("page_id").cast("string"), F.lit(".mdx")).alias("doc_path"), F.col("html").alias("body"))
    root = place(spark, "outputs")
    extra = spark.createDataFrame([("extra.mdx", "x")], "doc_path string, body string")
    sinks.write_pages(pages.where("page_id % 3 <> 1").select("doc_path", "body").unionByName(extra), root)
    return validate.unmatched_files(pages, files.read_outputs(spark, root))


@query(
    """SELECT r_name AS "group", 'cat' || r_regionkey AS category, n_name AS product, 'p' || n_nationkey AS path, CAST(n_nationkey AS DOUBLE) AS "order",
    'v1,v2' AS versions, 'v2' AS default_version FROM nation JOIN region ON n_regionkey = r_regionkey"""
)
def navigation(spark, sf_dir):
    """A navigation file made of regions and nations."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    tree: dict[str, dict] = {}
    for r in n.orderBy("n_nationkey").collect():  # 25 rows at every size
        group = tree.setdefault(r.r_name, {"name": r.r_name, "path": f"cat{r.r_regionkey}", "children": []})
        group["children"].append({"name": r.n_name, "path": f"p{r.n_nationkey}", "order": r.n_nationkey, "versions": ["v1", "v2"], "default_version": "v2"})
    path = place(spark, "nav") + "/nav.json"
    sinks.write_text(spark, path, [json.dumps({k: [v] for k, v in tree.items()})])
    return files.read_navigation(spark, path).withColumn("versions", F.array_join("versions", ","))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS message FROM nation")
def code_table(spark, sf_dir):
    path = place(spark, "codes") + "/codes.csv"
    lines = [f"{r.n_nationkey},{r.n_name}\n" for r in table(spark, sf_dir, "nation").collect()]  # 25 rows at every size
    sinks.write_text(spark, path, ["code,message\n", *lines])
    return files.read_codes(spark, path)


@query("""SELECT 'op' || o_orderkey AS operation_id, '{"id":' || o_orderkey || '}' AS parameters, '{"status":"' || o_orderstatus || '"}' AS body FROM orders WHERE o_orderpriority = '1-URGENT'""")
def payloads(spark, sf_dir):
    """A payload file for each urgent order."""
    o = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    body = F.struct(F.struct(F.col("o_orderkey").alias("id")).alias("parameters"), F.struct(F.col("o_orderstatus").alias("status")).alias("body"))
    root = place(spark, "payloads")
    sinks.write_files(spread(o.select(F.concat(F.lit("op"), F.col("o_orderkey").cast("string"), F.lit(".json")).alias("path"), F.to_json(body).alias("text"))), root)
    return files.read_payloads(spark, root)


@query(
    """SELECT '/p' || page_id AS source, '/p' || least((page_id // 37) * 37 + 36, (SELECT max(page_id) + 1 FROM pages)) AS target FROM pages WHERE page_id % 37 <> 36
    UNION ALL SELECT * FROM (VALUES ('/l', '/m'), ('/m', '/l'))"""
)
def redirect_targets(spark, sf_dir):
    """Chains of up to 36 redirects, and a loop."""
    edges = table(spark, sf_dir, "pages").where("page_id % 37 <> 36").selectExpr("concat('/p', page_id) AS source", "concat('/p', page_id + 1) AS target")
    edges = edges.unionByName(spark.createDataFrame([("/l", "/m"), ("/m", "/l")], "source string, target string"))
    path = place(spark, "redirects") + "/redirects.json"
    pairs = edges.select(F.to_json(F.create_map("source", "target")).alias("j")).toLocalIterator()
    sinks.write_text(spark, path, _json_object(r.j for r in pairs))
    return files.final_targets(files.read_redirects(spark, path))


def _json_object(entries: Iterable[str]) -> Iterator[str]:
    """One object of many of one entry."""
    yield "{"
    for i, entry in enumerate(entries):
        yield ("," if i else "") + "\n" + entry[1:-1]
    yield "\n}"


@query("SELECT source AS doc_path, doc_id AS chunk_seq, text AS content FROM documents")
def json_export(spark, sf_dir):
    """One JSON document of all rows, written and read again."""
    path = place(spark, "export") + "/chunks.json"
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("doc_path"), F.col("doc_id").alias("chunk_seq"), F.col("text").alias("content"))
    sinks.write_json_export(rows, path, {"stats": {"n": 1}})
    return sinks.read_json_export(spark, path)


# --- stores and syncs ------------------------------------------------------


@query("SELECT CAST(vec_id AS VARCHAR) AS id, CASE WHEN label < 3 THEN 'changed' ELSE CAST(label AS VARCHAR) END AS label, CAST(len(embedding) AS BIGINT) AS size FROM embeddings WHERE label <> 5")
def vector_store(spark, sf_dir):
    """Upserts and deletes as changes over a first version; ids and metadata through a backup."""
    store = stores.ParquetVectorStore(spark, place(spark, "vectors"))
    label = lambda c: F.create_map(F.lit("label"), c)
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("id"), "embedding", "label")
    store.upsert(rows.select("id", "embedding", label(F.col("label").cast("string")).alias("metadata")))
    store.upsert(rows.where("label < 3").select("id", "embedding", label(F.lit("changed")).alias("metadata")))
    store.delete(rows.where("label = 5"))
    backup = place(spark, "backup")
    store.backup(backup)
    kept = spark.read.schema("id string, metadata map<string,string>").json(backup)
    sizes = store.fetch(kept).select("id", long(F.size("embedding")).alias("size"))
    return kept.select("id", F.col("metadata")["label"].alias("label")).join(sizes, "id")


@query("SELECT DISTINCT sha256(text) AS content_hash, sha256(text) = sha256(text) AS intact FROM documents")
def content_store(spark, sf_dir):
    """Texts uploaded in two runs that overlap: each hash once, with its text."""
    rows = chunks(spark, sf_dir).select("content_hash", "content", "doc_path", F.lit("r").alias("source_repo"), F.lit("c").alias("commit_sha"), "section")
    store = stores.ParquetContentStore(spark, place(spark, "content"))
    store.upload(rows.where("section <> 'es'"))
    store.upload(rows)
    return store.contents().select("content_hash", (T.content_hash(F.col("content")) == F.col("content_hash")).alias("intact"))


def _objects(spark, sf_dir) -> DataFrame:
    facts = F.create_map(F.lit("lang"), F.col("lang"))
    return wide(spark, sf_dir).select(F.sha2("text", 256).alias("key"), F.col("text").alias("content"), facts.alias("facts"), "lang", "source")


@query(
    """SELECT DISTINCT sha256(text) AS key, CAST(strlen(text) AS BIGINT) AS size, substr(sha256(text), 1, 1) < '8' AS low,
    sha256(text) IN (SELECT sha256(text) FROM documents WHERE lang = 'fr') AS probed FROM documents"""
)
def paged_listing(spark, sf_dir):
    """Texts put into a paged store by two runs that overlap: listed page by page, narrowed by a pushed prefix, and probed."""
    rows, path = _objects(spark, sf_dir), place(spark, "paged")
    paged.put(rows.where("lang <> 'es'"), path)
    paged.put(rows, path)
    every = paged.listing(spark, path)
    low = paged.listing(spark, path, prefixes="0,1,2,3,4,5,6,7").select("key", F.lit(True).alias("low"))
    probed = paged.existing(rows.where("lang = 'fr'"), path, "key").select("key", F.lit(True).alias("probed"))
    out = every.join(low, "key", "left").join(probed, "key", "left")
    return out.select("key", "size", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("low", "probed")))


@query("SELECT 'after a failed write' AS phase, CAST(0 AS BIGINT) AS objects UNION ALL SELECT 'after a whole one', count(DISTINCT sha256(text)) FROM documents")
def paged_writes(spark, sf_dir):
    """A write with a task that fails leaves nothing; the next stores every text once."""
    rows, path = _objects(spark, sf_dir), place(spark, "paged")
    paged.register(spark)
    last = rows.agg(F.max("key")).first()[0]
    broken = rows.withColumn("content", F.when(F.col("key") == last, F.raise_error(F.lit("lost"))).otherwise(F.col("content")))
    counts = []
    try:
        broken.select("key", "content", "facts").write.format("paged_store").option("path", path).mode("append").save()
    except Exception:  # what the query is about
        counts.append(("after a failed write", paged.listing(spark, path).count()))
    paged.put(rows, path)
    counts.append(("after a whole one", paged.listing(spark, path).count()))
    return spark.createDataFrame(counts, "phase string, objects long")


@query(
    """SELECT CAST(vec_id AS VARCHAR) AS id, CAST(CASE WHEN vec_id % 100 = 7 THEN 4 ELSE 0 END AS INTEGER) AS version FROM embeddings WHERE vec_id % 50 <> 3"""
)
def bucketed_store(spark, sf_dir):
    """Four upserts of one row in a hundred and a delete, over a first write of all rows: buckets merge on read and are rewritten alone."""
    store = stores.ParquetVectorStore(spark, place(spark, "buckets"), buckets=16, most_changes=2)
    i = F.col("vec_id")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", i.cast("string").alias("id"), "embedding")
    at = lambda df, n: df.select("id", "embedding", F.create_map(F.lit("version"), F.lit(str(n))).alias("metadata"))
    store.upsert(at(rows, 0))
    for n in range(1, 5):
        store.upsert(at(rows.where(i % 100 == 7), n))
    store.delete(rows.where(i % 50 == 3))
    return store.vectors(spark).select("id", F.col("metadata")["version"].cast("int").alias("version"))


def _refuse(key: str, text: str, facts: dict) -> None:
    if "/src5/" in facts["doc-path"]:
        raise OSError("refused")


@query(
    with_cte(
        """SELECT content_hash, CASE WHEN contains(min(doc_path), '/src5/') THEN 'refused' END AS error FROM chunks
        WHERE content_hash NOT IN (SELECT content_hash FROM chunks WHERE section = 'es') GROUP BY content_hash"""
    )
)
def upload_settled(spark, sf_dir):
    """Uploads of what is not there yet; failures are settled, not fatal."""
    rows = chunks(spark, sf_dir).withColumns({"source_repo": F.lit("r"), "commit_sha": F.lit("c")})
    return sync.upload(rows, _refuse, rows.where("section = 'es'").select("content_hash"), base_ms=1)


class Picky(stores.HashEmbedder):
    """Fails for texts that begin with E."""

    def embed(self, text: str) -> list[float]:
        if text.startswith("E"):
            raise ValueError("no E")
        return super().embed(text)


@query("SELECT DISTINCT sha256(text) AS content_hash, starts_with(text, 'E') AS failed FROM documents")
def embed_errors(spark, sf_dir):
    rows = ranking.keep_first(chunks(spark, sf_dir).select("content_hash", "content", "doc_id"), "content_hash", "doc_id")
    return sync.embed(rows, Picky(8)).select("content_hash", F.col("error").isNotNull().alias("failed"))


class Busy(stores.HashEmbedder):
    """Throttles the first call of every text."""

    seen = ""

    def embed(self, text: str) -> list[float]:
        if self.seen != text:
            self.seen = text
            raise RuntimeError("throttled")
        return super().embed(text)


def _no_wait(seconds: float) -> None:
    return None


@query("SELECT DISTINCT sha256(text) AS content_hash, 2 AS calls FROM documents")
def embed_retries(spark, sf_dir):
    rows = ranking.keep_first(chunks(spark, sf_dir).select("content_hash", "content", "doc_id"), "content_hash", "doc_id")
    return sync.embed(rows, stores.PatientEmbedder(Busy(8), sleep=_no_wait)).where("error is null").select("content_hash", "calls")


def _sync_rows(spark, sf_dir) -> DataFrame:
    meta = F.create_map(F.lit("source"), F.col("source"))
    return chunks(spark, sf_dir).withColumns({"metadata": meta, "file_seq": F.col("doc_id"), "chunk_seq": F.lit(0)})


_EMBEDDABLE = f"SELECT DISTINCT content_hash AS h, section FROM chunks WHERE {_LABEL} = 'embeddable'"


@query(
    with_cte(
        f"""SELECT count(*) FILTER (o IS NULL) AS written, count(*) FILTER (o IS NOT NULL AND n IS NOT NULL) AS refreshed, count(*) FILTER (n IS NULL) AS deleted, 0 AS failed
        FROM (SELECT DISTINCT h AS o FROM ({_EMBEDDABLE}) WHERE section <> 'es') FULL OUTER JOIN (SELECT DISTINCT h AS n FROM ({_EMBEDDABLE}) WHERE section <> 'fr') ON o = n"""
    )
)
def sync_figures(spark, sf_dir):
    """A staged run over another run's store."""
    rows = _sync_rows(spark, sf_dir)
    store = stores.ParquetVectorStore(spark, place(spark, "sync"))
    none = spark.createDataFrame([], "content_hash string")
    first = sync.sync(rows.where("section <> 'es'"), none, store, stores.HashEmbedder(8), most_stages=2)
    second = sync.sync(rows.where("section <> 'fr'"), first.hashes, store, stores.HashEmbedder(8), most_stages=2)
    return spark.createDataFrame([(second.written, second.refreshed, second.deleted, second.failed)], "written long, refreshed long, deleted long, failed int")


@query(with_cte(f"SELECT DISTINCT h AS content_hash, 8 AS size FROM ({_EMBEDDABLE}) WHERE section <> 'fr'"))
def sync_store(spark, sf_dir):
    """What a store holds after two runs of which the second wants other rows."""
    rows = _sync_rows(spark, sf_dir)
    store = stores.ParquetVectorStore(spark, place(spark, "sync"))
    none = spark.createDataFrame([], "content_hash string")
    first = sync.sync(rows.where("section <> 'es'"), none, store, stores.HashEmbedder(8), most_stages=2)
    sync.sync(rows.where("section <> 'fr'"), first.hashes, store, stores.HashEmbedder(8), most_stages=2)
    return store.vectors(spark).select(F.col("id").alias("content_hash"), F.size("embedding").alias("size"))


# --- incremental run -------------------------------------------------------


def _doc_pages(spark, sf_dir, which: str, old: bool) -> DataFrame:
    text = letters()
    if old:
        text = F.when(F.col("source") == "src9", F.concat(F.lit("old "), text)).otherwise(text)
    page = F.concat(F.lit("# "), "source", F.lit("\n\n"), text)
    path = F.concat(F.lit("content/data/"), F.col("doc_id").cast("string"), F.lit(".md"))
    return wide(spark, sf_dir).where(which).select(path.alias("doc_path"), page.alias("text"))


@query(
    """SELECT count(*) FILTER (lang <> 'fr') AS files, count(*) FILTER (lang = 'es' OR (lang <> 'fr' AND source = 'src9')) AS processed,
    count(*) FILTER (lang NOT IN ('es', 'fr') AND source <> 'src9') AS skipped, count(*) FILTER (lang = 'fr') AS deleted FROM documents"""
)
def incremental_run(spark, sf_dir):
    """A second run below the same folder reads what is new or changed only, and drops what is gone."""
    out = place(spark, "run")
    pipeline.run(spark, _doc_pages(spark, sf_dir, "lang <> 'es'", True), None, out)
    return pipeline.run(spark, _doc_pages(spark, sf_dir, "lang <> 'fr'", False), None, out).select("files", "processed", "skipped", "deleted")


@query(
    f"""SELECT 'content/data/' || doc_id || '.md' AS doc_path, CASE WHEN lang = 'es' THEN 'new' WHEN source = 'src9' THEN 'updated' ELSE 'kept' END AS status,
    sha256(string_split({_LETTERS}, ' ')[1]) AS first_word FROM documents WHERE lang <> 'fr'"""
)
def incremental_chunks(spark, sf_dir):
    """The first chunk of every file after two runs, with its status."""
    out = place(spark, "run")
    pipeline.run(spark, _doc_pages(spark, sf_dir, "lang <> 'es'", True), None, out)
    pipeline.run(spark, _doc_pages(spark, sf_dir, "lang <> 'fr'", False), None, out)
    rows = pipeline.load_previous(spark, out).where("chunk_seq = 0")
    return rows.select("doc_path", "status", F.sha2(F.substring_index("content", " ", 1), 256).alias("first_word"))


# --- pages, sections, chunks -----------------------------------------------


@query(
    f"""SELECT doc_id, '**Note:** ' || t || chr(10) || chr(10) || 'R ' || t || chr(10) || chr(10) || '- one' || chr(10) || '- two' || chr(10) || chr(10) || 'docs (http://x) **b**' AS body
    FROM (SELECT doc_id, {_LETTERS} AS t FROM documents)"""
)
def normalize_page(spark, sf_dir):
    """Imports, a call-out, a wrapper, a list, a link, bold text, an expression and a component."""
    page = F.concat(
        F.lit("import A from 'b';\n\n<Callout type=\"info\">\n"), letters(), F.lit("\n</Callout>\n\n<Row>R "), letters(),
        F.lit("</Row>\n\n<ul><li>one</li><li>two</li></ul>\n\n[docs](http://x) <b>b</b>{name}\n\n<NextPage a=\"1\" />\n"),
    )
    return wide(spark, sf_dir).select("doc_id", M.normalize_page(page).alias("body"))


@query(
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_path, 3 AS before, CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 0 END AS after, doc_id % 3 <> 1 AS lost,
    doc_id % 3 <> 1 AND length({_LETTERS}) + 12 > 100 AS emptied FROM documents"""
)
def heading_loss(spark, sf_dir):
    text = F.concat(F.lit("# A\n# B\n# C\n"), letters())
    body = F.when(F.col("doc_id") % 3 == 0, "# A").when(F.col("doc_id") % 3 == 1, text).otherwise("")
    return validate.heading_loss(wide(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc_path"), text.alias("text"), body.alias("body")))


@query("""SELECT doc_id, source AS page_title, lang AS sidebar_title, '3' AS "order", 'true' AS visible_in_sidebar, sha256(text) AS content_hash FROM documents""")
def front_yaml(spark, sf_dir):
    """Front matter read as YAML: quoted, folded and typed scalars."""
    page = F.concat(
        F.lit('---\npage_title: "'), "source", F.lit("\"\nsidebar_title: >-\n  "), "lang", F.lit("\norder: 3\nvisible_in_sidebar: true\nother: [1, 2]\n---\n"), "text"
    )
    rows = wide(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc_path"), page.alias("text"))
    out = pipeline.page_bodies(rows, normalize=False)
    return out.select(long("doc_path").alias("doc_id"), *pipeline.FRONT, T.content_hash(F.col("body")).alias("content_hash"))


SECTIONS_SQL = f"""SELECT doc_id, CAST(seq AS INTEGER) AS seq, CAST(seq + 1 AS INTEGER) AS level, CASE seq WHEN 0 THEN source ELSE lang END AS heading,
    CASE seq WHEN 0 THEN source ELSE source || ' > ' || lang END AS section,
    CASE seq WHEN 0 THEN t ELSE t || chr(10) || 'second' || chr(10) || chr(10) || 'said ' || t || chr(10) || chr(10) || '```x' || chr(10) || t || chr(10) || '```'
      || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'a b' || chr(10) || t || ' d' || chr(10) || chr(10) || 'bold' END AS content
    FROM (SELECT *, {_LETTERS} AS t FROM documents), (SELECT unnest([0, 1]) AS seq)"""


def section_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_path, body) with two headings; below the second a list, a quote, a code block that comes twice, a break, a table and HTML."""
    t = letters()
    body = F.concat(
        F.lit("# "), "source", F.lit("\n\n"), t, F.lit("\n\n"), "lang", F.lit("\n---\n\n- "), t, F.lit("\n- second\n\n> said "), t, F.lit("\n\n```x\n"), t,
        F.lit("\n```\n\n```x\n"), t, F.lit("\n```\n\n---\n\n| a | b |\n|---|---|\n| "), t, F.lit(" | d |\n\n<div><b>bold</b></div>\n"),
    )
    return wide(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc_path"), body.alias("body"))


@query(SECTIONS_SQL)
def sections_tree(spark, sf_dir):
    """The sections of pages with blocks of all kinds."""
    rows = sections.sections_tree(section_pages(spark, sf_dir))
    return rows.select(long("doc_path").alias("doc_id"), "seq", "level", "heading", sections.flat_path(F.col("section_path")).alias("section"), "content")


# Letters have one token a word and no sentence ends: up to 1500 tokens are one chunk, more are cut by words at 700.
_CUT = f"""w AS (SELECT doc_id, lang, source, string_split({_LETTERS}, ' ') AS w FROM documents),
cut AS (SELECT doc_id, lang, source, i AS chunk_seq, CASE WHEN len(w) <= 1500 THEN w ELSE w[i * 700 + 1:i * 700 + 700] END AS part
  FROM (SELECT *, unnest(range(0, CASE WHEN len(w) <= 1500 THEN 1 ELSE CAST(ceil(len(w) / 700.0) AS BIGINT) END)) AS i FROM w))"""


@query(
    f"""WITH {_CUT} SELECT CAST(doc_id AS VARCHAR) AS doc_path, CAST(chunk_seq AS INTEGER) AS chunk_seq, lang AS section, CAST(len(part) AS INTEGER) AS token_count,
    sha256(array_to_string(part, ' ')) AS content_hash FROM cut"""
)
def split_oversized(spark, sf_dir):
    """Documents as one long paragraph without sentence ends."""
    rows = wide(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("doc_path"), F.lit(0).alias("seq"), F.col("lang").alias("section"), F.array("lang").alias("section_path"), letters().alias("content")
    )
    return chunk_documents(rows).select("doc_path", "chunk_seq", "section", "token_count", T.content_hash(F.col("content")).alias("content_hash"))


@query(
    f"""WITH {_CUT} SELECT 'content/payments/' || doc_id || '.mdx' AS doc_path, CAST(chunk_seq AS INTEGER) AS chunk_seq, 'Page' AS section, 'Page | Side' AS page_context,
    'https://docs.example.com/payments/' || doc_id AS url, sha256(array_to_string(part, ' ')) AS content_hash, CAST(len(part) AS INTEGER) AS token_count,
    len(part) > 1200 AS is_oversized FROM cut"""
)
def ingest_documents(spark, sf_dir):
    """Pages through front matter, normalisation, sections, chunker, cleaning, enrichment and the file gate."""
    page = F.concat(F.lit("---\npage_title: Page\nsidebar_title: Side\norder: 1\n---\n# Page\n\n"), letters())
    path = F.concat(F.lit("content/payments/"), F.col("doc_id").cast("string"), F.lit(".mdx"))
    good, _ = pipeline.ingest(wide(spark, sf_dir).select(path.alias("doc_path"), page.alias("text")))
    return good.select("doc_path", "chunk_seq", "section", "page_context", "url", "content_hash", "token_count", "is_oversized")


@query(
    """SELECT doc_id, md5(array_to_string(list_transform(list_filter(string_split_regex(text, '[ \\n]+'), lambda w: w <> ''), lambda w: 'w' || w), ' ')) AS words FROM documents"""
)
def chunk_words(spark, sf_dir):
    """Chunks of whole documents (their lines as paragraphs) hold every word once and in order; a letter before each keeps it from being a mark."""
    words = lambda line: F.transform(F.filter(F.split(line, " "), lambda w: w != ""), lambda w: F.concat(F.lit("w"), w))
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.array_join(words(x), " ")), lambda x: x != "")
    body = F.concat(F.lit("# T\n\n"), F.array_join(lines, "\n\n"))
    rows = chunk_pages(wide(spark, sf_dir).select("doc_id", body.alias("body")))
    whole = F.array_join(F.transform("chunks", lambda c: c["content"]), " ")
    return rows.select("doc_id", F.md5(F.array_join(F.filter(F.split(whole, "[ \n]+"), lambda w: w != ""), " ")).alias("words"))


@query(
    rf"""WITH s AS (SELECT doc_id, i, p[i] AS s, CAST(len(regexp_extract_all(p[i], '\p{{L}}+|\p{{N}}{{1,3}}|[^\s\p{{L}}\p{{N}}]')) AS BIGINT) AS n
      FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS p FROM documents))),
    c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i DESC) AS upto FROM s),
    t AS (SELECT doc_id, string_agg(s, ' ' ORDER BY i) AS o FROM c WHERE upto <= 100 AND upto - n < 60 GROUP BY doc_id)
    SELECT d.doc_id, CASE WHEN {TOKENS_SQL} < 120 THEN '' ELSE coalesce(regexp_replace(o, '^\s+|\s+$', '', 'g'), '') END AS overlap FROM documents d LEFT JOIN t ON t.doc_id = d.doc_id"""
)
def overlap_tail(spark, sf_dir):
    return wide(spark, sf_dir).select("doc_id", T.overlap_tail(F.col("text")).alias("overlap"))


# --- JSON and specifications -----------------------------------------------


@query("""SELECT event_id, '{"9":2,"10":1,"a":' || replace(props, ' ', '') || ',"b":[1,{"a":"x","z":' || event_id || '}]}' AS props FROM events""")
def stable_json(spark, sf_dir):
    """Keys in order at all levels, whole numbers first."""
    text = F.concat(F.lit('{"b": [1, {"z": '), F.col("event_id").cast("string"), F.lit(', "a": "x"}], "10": 1, "a": '), "props", F.lit(', "9": 2}'))
    return table(spark, sf_dir, "events").select("event_id", apispec.json_text(text).alias("props"))


@query("""SELECT event_id, '{"k":' || event_id || ',"l":"two\\nlines","q":"it''s"}' AS props FROM events""".replace("it''s", "one"))
def json_repair(spark, sf_dir):
    """Trailing commas, single-quoted values and raw line ends are mended; what is no JSON gives null."""
    text = F.concat(F.lit('{"q": \'one\', "l": "two\nlines", "k": '), F.col("event_id").cast("string"), F.lit(",}"))
    return table(spark, sf_dir, "events").select("event_id", apispec.json_text(text).alias("props"))


def _event_specs(spark, sf_dir) -> DataFrame:
    i = F.col("event_id").cast("string")
    parts = (
        '{"openapi":"3.0.1","info":{"title":"T', i, '","version":"1"},"paths":{"/e/', i, '/{x}":{"get":{"operationId":"getItem', i,
        '","tags":["b","a"],"parameters":[{"name":"zeta","in":"query","schema":{"type":"integer","format":"int64"}},'
        '{"name":"x","in":"path","required":true,"schema":{"$ref":"#/components/schemas/Id"}},{"name":"zeta","in":"query","description":"last","schema":{"type":"string"}}],'
        '"responses":{"404":{"description":"no"},"200":{"description":"ok","headers":{"Date":{},"X-Rate":{"schema":{"type":"integer"}}},"content":{"application/json":{"schema":{"$ref":"#/components/schemas/Item"}}}}}}}},'
        '"components":{"schemas":{"Id":{"type":"string","format":"uuid"},"Item":{"type":"object","required":["k"],"properties":{"k":{"type":"integer"},'
        '"e":{"type":"array","items":{"type":"string"}},"o":{"type":"object","properties":{"in":{"enum":["u","v"]}}}}}}}}',
    )
    text = F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    return wide(spark, sf_dir, "events").select(F.concat(F.lit("events/"), "event_type", F.lit("/"), i, F.lit(".json")).alias("path"), text.alias("text"))


@query(
    """SELECT 'events/' || event_type || '/' || event_id || '.json' AS path, 0 AS seq, 'GET' AS method, '/e/' || event_id || '/{x}' AS route, 'getItem' || event_id AS operation_id,
    'a,b' AS tags, 'zeta:string,x:string (uuid)' AS parameters, 0 AS n_body, '200,404' AS statuses, 'get-item' || event_id AS slug FROM events"""
)
def endpoint_table(spark, sf_dir):
    """References resolved; of parameters with one name and place the first place and the last value stay."""
    rows = apispec.endpoint_table(_event_specs(spark, sf_dir))
    params = F.array_join(F.transform("parameters", lambda p: F.concat_ws(":", p["name"], p["type"])), ",")
    return rows.select("path", "seq", "method", "route", "operation_id", F.array_join("tags", ",").alias("tags"), params.alias("parameters"), F.size("body_properties").alias("n_body"), F.array_join("statuses", ",").alias("statuses"), "slug")


_MARKDOWN = """'# T' || event_id || '\n\n**Version:** 1\n\n## GET /e/' || event_id || '/{x}\n\n**Tags:** a, b\n
### Parameters\n- `x` (path, string (uuid), **required**)\n- `zeta` (query, string, optional) — last\n
### Response 200 — ok\n\n**Headers:**\n- `X-Rate` (integer)\n\n- `e` (array of string, optional)\n- `k` (integer, **required**)\n- `o` (object, optional)\n- `o.in` (enum (u, v), optional)\n
### Response 404 — no\n\n---\n## RAG Metadata\n- source_type: api-spec\n- product: ' || event_type || '/' || event_id || '\n- category: events\n- spec_version: openapi3\n'"""


@query(f"SELECT 'events/' || event_type || '/' || event_id || '.json' AS path, 'events/' || event_type || '/' || event_id || '.md' AS out_path, {_MARKDOWN} AS markdown FROM events")
def spec_markdown(spark, sf_dir):
    return apispec.spec_files(_event_specs(spark, sf_dir)).where("error is null").select("path", "out_path", "markdown")


@query(
    """SELECT 'events/' || event_type || '/' || event_id AS product, 'openapi3' AS spec_version, 'api-reference/events/' || event_type || '/' || event_id || '.md' AS doc_path, 'T' || event_id AS page_title,
    'api-spec' AS source_type, 'events' AS category FROM events""".replace("'events/' || event_type || '/' || event_id AS product", "event_type || '/' || event_id AS product")
)
def ingest_specs(spark, sf_dir):
    """Specifications to chunks, with the metadata of their footers."""
    good, _ = pipeline.ingest_specs(_event_specs(spark, sf_dir))
    keys = ("product", "category", "source_type", "spec_version", "page_title")
    return good.where("chunk_seq = 0").select("doc_path", *(F.col(f"metadata.{k}").alias(k) for k in keys))


# --- gates -----------------------------------------------------------------


@query(with_cte("SELECT count(*) AS files, count(*) FILTER (token_count > 700) AS above, max(token_count) AS most, arg_max(doc_id, (token_count, doc_id)) AS file, false AS passed FROM chunks"))
def token_ceiling(spark, sf_dir):
    g = validate.token_ceiling(chunks(spark, sf_dir), C.SOFT_MAX_CHUNK, path="doc_id")
    return spark.createDataFrame([(*(g.figures[k] for k in ("files", "above", "most", "file")), g.passed)], "files long, above long, most long, file long, passed boolean")


@query(
    with_cte(
        f"""SELECT 'least count' AS gate, count(*) >= 200 AS passed FROM chunks UNION ALL SELECT 'least count too high', false
        UNION ALL SELECT 'required fields', true UNION ALL SELECT 'hash format', count(*) FILTER (source = 'src2') = 0 FROM chunks
        UNION ALL SELECT 'specification metadata', count(*) FILTER ({_FORCED} AND source = 'src3') = 0 FROM chunks
        UNION ALL SELECT 'specification metadata full', true
        UNION ALL SELECT 'content sample', true UNION ALL SELECT 'content sample empty', count(*) = 0 FROM chunks"""
    )
)
def gates(spark, sf_dir):
    """The checks before and after a sync, on rows that pass and rows that don't."""
    rows = chunks(spark, sf_dir)
    upper = F.when(F.col("source") == "src2", F.upper("content_hash")).otherwise(F.col("content_hash"))
    meta = lambda st: rows.withColumn("metadata", F.struct(F.lit("p").alias("product"), F.lit("c").alias("category"), st.alias("source_type"), F.lit("v").alias("spec_version")))
    none = spark.createDataFrame([], "content_hash string")
    found = [
        ("least count", validate.least_count(rows, C.MIN_CHUNKS_SMOKE)),
        ("least count too high", validate.least_count(rows, 1 << 40)),
        ("required fields", validate.required_fields(rows)),
        ("hash format", validate.hash_format(rows.withColumn("content_hash", upper))),
        ("specification metadata", validate.spec_metadata(meta(F.when(F.col("source") != "src3", F.lit("api-spec"))))),
        ("specification metadata full", validate.spec_metadata(meta(F.lit("api-spec")))),
        ("content sample", validate.content_sample(rows, rows.select("content_hash").distinct(), "doc_id")),
        ("content sample empty", validate.content_sample(rows, none, "doc_id")),
    ]
    return spark.createDataFrame([(n, g.passed) for n, g in found], "gate string, passed boolean")


@query("SELECT CAST(vec_id AS VARCHAR) AS id FROM embeddings")
def list_ids(spark, sf_dir):
    """The complete listing."""
    from ..operators import vectors

    return vectors.list_ids(table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("id")))


@query(f"WITH RECURSIVE {CHUNKS_SQL} SELECT doc_path, CAST(count(*) AS BIGINT) AS n, string_agg(doc_id, ',' ORDER BY doc_id) AS ids FROM chunks GROUP BY doc_path")
def chunks_by_file(spark, sf_dir):
    rows = incremental.by_file(chunks(spark, sf_dir).select("doc_path", "doc_id"), "doc_id")
    return rows.select("doc_path", long(F.size("chunks")).alias("n"), F.array_join(F.transform("chunks", lambda c: c["doc_id"].cast("string")), ",").alias("ids"))


def _op(spark, sf_dir, op: str) -> DataFrame:
    plan = sync.sync_plan(chunks(spark, sf_dir), previous(spark, sf_dir))
    return plan.where(F.col("op") == op).select("content_hash")


@query(with_cte("SELECT DISTINCT content_hash FROM chunks WHERE content_hash NOT IN (SELECT content_hash FROM previous)"))
def sync_insert(spark, sf_dir):
    return _op(spark, sf_dir, "insert")


@query(with_cte("SELECT DISTINCT content_hash FROM chunks WHERE content_hash IN (SELECT content_hash FROM previous)"))
def sync_update(spark, sf_dir):
    return _op(spark, sf_dir, "update")


@query(with_cte("SELECT DISTINCT content_hash FROM previous WHERE content_hash NOT IN (SELECT content_hash FROM chunks)"))
def sync_delete(spark, sf_dir):
    return _op(spark, sf_dir, "delete")


# --- streams ---------------------------------------------------------------

# Three listings of documents as files: some are missing, some changed, and in the last all are as at first.
_LISTINGS = """l AS (
  SELECT doc_id, 0 AS run, sha256(text) AS h FROM documents WHERE doc_id % 5 <> 0
  UNION ALL SELECT doc_id, 1, sha256(text || CASE WHEN doc_id % 3 = 0 THEN ' changed' ELSE '' END) FROM documents WHERE doc_id % 4 <> 0
  UNION ALL SELECT doc_id, 2, sha256(text) FROM documents)"""


@query(
    f"""WITH {_LISTINGS}, d AS (SELECT doc_id, run FROM (SELECT DISTINCT doc_id FROM documents), (SELECT unnest([0, 1, 2]) AS run)),
    s AS (SELECT d.doc_id, d.run, h, lag(h) OVER (PARTITION BY d.doc_id ORDER BY d.run) AS before FROM d LEFT JOIN l USING (doc_id, run))
    SELECT CAST(doc_id AS VARCHAR) AS doc_path, CAST(run AS BIGINT) AS run, CASE WHEN h IS NULL THEN 'removed' WHEN before IS NULL THEN 'new' ELSE 'changed' END AS action, h AS file_hash
    FROM s WHERE h IS DISTINCT FROM before"""
)
def stream_changes(spark, sf_dir):
    """Changes that the stream finds between three listings of all documents."""
    work = place(spark, "changes")
    i = F.col("doc_id")
    docs = wide(spark, sf_dir)
    versions = (
        docs.where(i % 5 != 0),
        docs.where(i % 4 != 0).withColumn("text", F.when(i % 3 == 0, F.concat("text", F.lit(" changed"))).otherwise(F.col("text"))),
        docs,
    )
    for files_now in versions:
        streams.take_listing(files_now.select(i.cast("string").alias("doc_path"), F.sha2("text", 256).alias("file_hash")), f"{work}/listings")
        write = lambda found, number: found.write.mode("overwrite").parquet(f"{work}/out/batch={number}")
        streams.change_stream(spark, f"{work}/listings", f"{work}/checkpoint", write).awaitTermination()
    return spark.read.option("basePath", f"{work}/out").parquet(f"{work}/out").select("doc_path", "run", "action", "file_hash")


_CHANGED = _CUT.replace(f"string_split({_LETTERS}", f"string_split(CASE WHEN source = 'src9' THEN 'second ' ELSE '' END || {_LETTERS}")


@query(
    f"""WITH {_CHANGED} SELECT CAST(doc_id AS VARCHAR) || '.md' AS doc_path, CAST(chunk_seq AS INTEGER) AS chunk_seq, sha256(array_to_string(part, ' ')) AS content_hash, CAST(len(part) AS INTEGER) AS token_count
    FROM cut WHERE lang <> 'de'"""
)
def stream_chunks(spark, sf_dir):
    """Documents as pages in two runs of the change stream: French ones come, German ones go, those of one source change."""
    work = place(spark, "stream")
    path = F.concat(F.col("doc_id").cast("string"), F.lit(".md"))
    first = F.concat(F.lit("# Page\n\n"), letters())
    second = F.concat(F.lit("# Page\n\n"), F.when(F.col("source") == "src9", F.lit("second ")).otherwise(F.lit("")), letters())
    for missing, text in (("fr", first), ("de", second)):
        pages = wide(spark, sf_dir).where(F.col("lang") != missing).select(path.alias("doc_path"), text.alias("text"))
        streams.ingest_changes(spark, pages, work).awaitTermination()
    return streams.latest_chunks(spark, work).select("doc_path", "chunk_seq", "content_hash", "token_count")


@query(with_cte(f"SELECT DISTINCT h AS content_hash, 8 AS size FROM ({_EMBEDDABLE}) WHERE section <> 'fr'"))
def stream_sync(spark, sf_dir):
    """Chunks as files, put into a store batch by batch in two runs of the stream; what the second table lacks is pruned."""
    rows, work = _sync_rows(spark, sf_dir), place(spark, "stream-sync")
    store = stores.ParquetVectorStore(spark, f"{work}/vectors")
    for n, wanted in enumerate(("section <> 'es'", "section <> 'fr'")):
        rows.where(wanted).write.parquet(f"{work}/chunks/batch={n}")  # as the scan deals them: a fixed number of files would grow with the input
        vector_streams.sync_stream(spark, f"{work}/chunks", store, stores.HashEmbedder(8), f"{work}/checkpoint").awaitTermination()
    vector_streams.prune(spark, store, rows.where("section <> 'fr'"))
    return store.vectors(spark).select(F.col("id").alias("content_hash"), F.size("embedding").alias("size"))
