"""Whole runs: pages to chunks, specifications to chunks, chunks to vectors."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import markup as M
from ..functions import text as T
from ..functions.tokens import count_udf
from ..operators import apispec, filters, incremental
from ..operators.chunking import Count, chunk_pages, regex_tokens
from ..operators.sections import front_values
from ..scratch import settled
from ..shipping import ship
from ..sources.files import exists

SPEC_FOLDER = "api-reference/"
SPEC_SOURCE = "specifications:"  # paths of specification files among those of pages
FRONT = ("page_title", "sidebar_title", "order", "visible_in_sidebar")


def page_bodies(pages: DataFrame, normalize: bool = True) -> DataFrame:
    """(doc_path, body, front values) of pages (doc_path, text); front matter is YAML and kept apart from the body."""
    ship(pages.sparkSession)
    text = F.regexp_replace("text", "\r\n", "\n")
    parts = pages.select("doc_path", front_values(FRONT)(text).alias("page"))
    body = M.normalize_page(F.col("page.body")) if normalize else F.col("page.body")
    return parts.select("doc_path", body.alias("body"), *(F.col(f"page.{k}").alias(k) for k in FRONT))


def clean_chunks(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chunk rows with clean content, the pages that fail) of pages with chunks; one blank chunk fails its page."""
    # Cleaning leaves something of any text that is not blank, so chunks are judged as they come, and cleaned only where their content is used.
    blank = F.exists("chunks", lambda c: T.trim_ws(c["content"]) == "")
    rows = pages.select(*(c for c in pages.columns if c != "chunks"), F.explode(F.when(~blank, F.col("chunks"))).alias("__c"))
    rows = rows.select("*", "__c.*").drop("__c")
    return rows.withColumn("content", T.clean_content(F.col("content"))), pages.where(blank).select("doc_path")


def enrich(rows: DataFrame, git: dict[str, str], base_url: str, count: Count | None = None) -> DataFrame:
    """Count clean chunks again, and add hash, url, context and metadata."""
    tokens = count_udf(count, F.col("content")) if count else T.token_count(F.col("content"))
    rows = rows.withColumn("token_count", tokens)
    path = F.col("doc_path")
    pick = lambda name, other: F.coalesce(F.col(name), other) if name in rows.columns else other
    metadata = F.struct(
        pick("product", T.product_of(path)).alias("product"),
        pick("category", T.category_of(path)).alias("category"),
        F.col("page_title"),
        F.col("sidebar_title"),
        F.col("order").cast("double").alias("order"),
        pick("source_type", F.lit(None).cast("string")).alias("source_type"),
        pick("spec_version", F.lit(None).cast("string")).alias("spec_version"),
    )
    return rows.select(
        "content",
        "doc_path",
        "section",
        "section_path",
        T.page_context(F.col("page_title"), F.col("sidebar_title")).alias("page_context"),
        T.public_url(path, base_url).alias("url"),
        T.content_hash(F.col("content")).alias("content_hash"),
        F.lit(git.get("repo_name", "unknown")).alias("source_repo"),
        F.lit(git.get("commit_sha", "unknown")).alias("commit_sha"),
        "token_count",
        filters.is_oversized(F.col("token_count")).alias("is_oversized"),
        metadata.alias("metadata"),
        "chunk_seq",
        T.chunk_id(path, F.col("section")).alias("chunk_id"),
    )


def ingest(
    pages: DataFrame,
    git: dict[str, str] | None = None,
    base_url: str = "https://docs.example.com",
    cfg: C.ChunkingConfig | None = None,
    normalize: bool = True,
    count: Count | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(chunks, failed files) of pages (doc_path, text); map-only, `count` is another token counter."""
    rows, failed = clean_chunks(chunk_pages(page_bodies(pages, normalize), cfg, count or regex_tokens))
    return enrich(rows, git or {}, base_url, count), failed


def ingest_specs(
    specs: DataFrame, git: dict[str, str] | None = None, base_url: str = "https://docs.example.com", count: Count | None = None
) -> tuple[DataFrame, DataFrame]:
    """(chunks, failed files) of specifications (path, text), through their Markdown; map-only."""
    files = apispec.spec_files(specs).where("error is null")
    keys = ("product", "category", "source_type", "spec_version")
    title = F.nullif(F.regexp_extract("markdown", r"(?m)^# (.+)$", 1), F.lit(""))
    rag = T.rag_metadata(F.col("markdown"))
    pages = files.select(F.concat(F.lit(SPEC_FOLDER), "out_path").alias("doc_path"), F.col("markdown").alias("body"), title.alias("page_title"), rag.alias("rag"))
    pages = pages.select("doc_path", "body", "page_title", F.col("page_title").alias("sidebar_title"), F.lit(None).cast("string").alias("order"), *(F.nullif(F.col("rag")[k], F.lit("")).alias(k) for k in keys))
    rows, failed = clean_chunks(chunk_pages(pages, None, count or regex_tokens))
    return enrich(rows, git or {}, base_url, count), failed


def combine(pages: DataFrame, specs: DataFrame) -> DataFrame:
    """Page chunks with the specification rows replaced."""
    return incremental.replace_prefix(pages, specs, SPEC_FOLDER)


def run_stats(chunks: DataFrame) -> DataFrame:
    """One row: files, chunks, tokens, mean tokens (0 without chunks), oversized chunks."""
    return chunks.agg(
        F.countDistinct("doc_path").alias("files"),
        F.count("*").alias("chunks"),
        F.coalesce(F.sum("token_count"), F.lit(0)).alias("tokens"),
        F.coalesce(F.round(F.avg("token_count")), F.lit(0.0)).alias("avg_tokens"),
        F.count_if("is_oversized").alias("oversized"),
    )


def load_previous(spark: SparkSession, out: str, name: str = "chunks") -> DataFrame | None:
    """A table of the last run below out; None if there is none or it can't be read, which means a first run."""
    for path in (f"{out}/{name}", f"{out}/{name}.old"):  # the second if the last swap was cut short
        if exists(spark, path):
            try:
                return spark.read.parquet(path)
            except AnalysisException:
                return None
    return None


def swap(table: DataFrame, out: str, name: str = "chunks") -> DataFrame:
    """Write a table that may read its own predecessor, then put it in that place."""
    spark = table.sparkSession
    draft = f"{out}/{name}.{uuid.uuid4().hex}"
    table.write.parquet(draft)
    at = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in (f"{out}/{name}", f"{out}/{name}.old", draft)]
    fs = at[0].getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(at[0]):
        fs.delete(at[1], True)
        fs.rename(at[0], at[1])
    fs.rename(at[2], at[0])
    fs.delete(at[1], True)
    return spark.read.parquet(f"{out}/{name}")


def file_hashes(files: DataFrame, path: str = "doc_path", text: str = "text") -> DataFrame:
    return files.select(F.col(path).alias("doc_path"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("file_hash"))


def run(
    spark: SparkSession,
    pages: DataFrame,
    specs: DataFrame | None,
    out: str,
    git: dict[str, str] | None = None,
    full: bool = False,
    by_revision: bool = False,
    count: Count | None = None,
) -> DataFrame:
    """Ingest what is new or changed since the last run below out, and drop what is gone; the run's stats.

    Files are compared by content hash; with by_revision another (or unknown)
    revision means all files again, and with full all of them in any case.
    Specifications are read again, all of them, if any of them changed; without
    `specs` (none given, which is not an empty table) those of the last run stay.
    """
    git = git or {}
    now = file_hashes(pages)
    if specs is not None:
        now = now.unionByName(file_hashes(specs, "path").withColumn("doc_path", F.concat(F.lit(SPEC_SOURCE), "doc_path")))
    old, files = (None, None) if full else (load_previous(spark, out, n) for n in ("chunks", "files"))
    if old is None or files is None:
        old = files = None
    below = lambda top: F.col("doc_path").startswith(top)
    held = [load_previous(spark, out, n) for n in ("chunks", "files")] if specs is None else [None, None]
    if held[0] is None or held[1] is None:
        held = None
    elif files is not None:
        files = files.where(~below(SPEC_SOURCE))
    sha = git.get("commit_sha", "unknown")
    before = sha
    if by_revision and files is not None:
        before = files.agg(F.max("commit_sha")).first()[0]
    known = sha if by_revision else "any"
    todo = settled(incremental.files_to_process(now, files, known, before if by_revision else "any"))
    again = todo.where("action = 'process'")
    changed = pages.join(again, "doc_path", "left_semi")
    chunks, _ = ingest(changed, git, count=count)
    if specs is not None:
        same = old is not None and todo.where(below(SPEC_SOURCE) & (F.col("action") != "skip")).isEmpty()
        made = old.where(below(SPEC_FOLDER)).drop("status") if same else ingest_specs(specs, git, count=count)[0]
        chunks = chunks.unionByName(made.withColumn("__same", F.lit(same)), allowMissingColumns=True)
        chunks = chunks.withColumn("status", F.when(F.col("__same"), "kept")).drop("__same")
    else:
        chunks = chunks.withColumn("status", F.lit(None).cast("string"))
    if old is None:
        merged = chunks.withColumn("status", F.lit("new"))
    else:
        merged = incremental.carry_over(chunks, old.where(~below(SPEC_FOLDER)).drop("status"), old, todo)
    now = now.withColumn("commit_sha", F.lit(sha))
    if held:
        merged = merged.unionByName(held[0].where(below(SPEC_FOLDER)).withColumn("status", F.lit("kept")), allowMissingColumns=True)
        now = now.unionByName(held[1].where(below(SPEC_SOURCE)))
    swap(merged, out)
    swap(now, out, "files")
    figures = todo.agg(*(F.count_if(F.col("action") == a).alias(n) for a, n in (("process", "processed"), ("skip", "skipped"), ("deleted", "deleted"))))
    return run_stats(spark.read.parquet(f"{out}/chunks")).crossJoin(figures)  # one row by one row
