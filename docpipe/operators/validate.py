"""Gates over chunks, files and stores: each gives rows or a (passed, figures) pair."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T
from . import filters

# Metadata that specification chunks must carry, and tags that normalised pages must not.
SPEC_KEYS = ("product", "category", "source_type", "spec_version")
HTML_LEFT = "div|span|p|br|hr|a|img|table|thead|tbody|tr|th|td|ul|ol|li|strong|em|b|i|code|pre|details|summary"
_FENCED = "(?s)```.*?```"


@dataclass(frozen=True)
class Gate:
    name: str
    passed: bool
    figures: dict


def meaningful_words(body: Column) -> Column:
    """Lower-case words of three signs or more, outside code and urls."""
    plain = F.regexp_replace(F.regexp_replace(body, _FENCED, ""), r"https?://[^\s)]+", "")
    words = F.split(F.lower(F.regexp_replace(plain, r"[^a-zA-Z0-9\s]", " ")), r"\s+")
    return F.filter(words, lambda w: F.length(w) > 2)


def headings(body: Column) -> Column:
    return F.transform(F.regexp_extract_all(body, F.lit(r"(?m)^#{1,6}\s+(.+)$"), F.lit(1)), T.trim_ws)


def markup_left(body: Column) -> Column:
    """Component and HTML tags outside code, but for one-word place holders."""
    plain = F.regexp_replace(body, _FENCED, "")
    found = F.concat(*(F.regexp_extract_all(plain, F.lit(p), F.lit(0)) for p in (r"<[A-Z][a-zA-Z]+[^>]*>", f"(?i)<(?:{HTML_LEFT})[^>]*>")))
    return F.filter(found, lambda t: ~t.rlike("(?i)^<[a-z_-]+>$"))


def front_matter_converted(page: Column, normalized: Column) -> Column:
    return ~page.startswith("---\n") | normalized.startswith("Metadata\n")


def heading_loss(pages: DataFrame) -> DataFrame:
    """Per page (doc_path, text, body): headings before and after, whether under half are left, whether the text went."""
    before, after = F.size(headings(F.col("text"))), F.size(headings(F.col("body")))
    return pages.select(
        "doc_path",
        before.alias("before"),
        after.alias("after"),
        ((before > 0) & (after < 0.5 * before)).alias("lost"),
        ((F.length(T.trim_ws(F.col("text"))) > 100) & (F.length(T.trim_ws(F.col("body"))) <= 50)).alias("emptied"),
    )


def token_ceiling(rows: DataFrame, limit: int = C.SPEC_FILE_HARD_LIMIT, path: str = "path", tokens: str = "token_count") -> Gate:
    """No file above the limit; no file at all fails too."""
    r = rows.agg(F.count("*").alias("files"), F.count_if(F.col(tokens) > limit).alias("above"), F.max(tokens).alias("most"), F.max_by(path, F.struct(tokens, path)).alias("file")).first()
    return Gate("token ceiling", r.files > 0 and r.above == 0, r.asDict())


def least_count(chunks: DataFrame, least: int) -> Gate:
    n = chunks.count()
    return Gate("least count", n >= least, {"chunks": n, "least": least})


def required_fields(chunks: DataFrame) -> Gate:
    names = tuple(c for c in filters.REQUIRED if c in chunks.columns)
    n = filters.violations(chunks, names).count()
    return Gate("required fields", n == 0, {"violations": n})


def hash_format(chunks: DataFrame) -> Gate:
    n = chunks.where(filters.bad_hash(F.col("content_hash"))).count()
    return Gate("hash format", n == 0, {"bad": n})


def spec_metadata(chunks: DataFrame) -> Gate:
    """Chunks below api-reference/ carry all keys."""
    missing = F.exists(F.array(*(F.col(f"metadata.{k}") for k in SPEC_KEYS)), lambda x: F.coalesce(x, F.lit("")) == "")
    n = chunks.where(F.col("doc_path").startswith("api-reference/") & missing).count()
    return Gate("specification metadata", n == 0, {"missing": n})


def unmatched_files(source: DataFrame, output: DataFrame) -> DataFrame:
    """(path, side) of source pages without an output file, and of outputs without a source; .mdx pages give .md files."""
    want = source.select(F.regexp_replace("doc_path", r"\.mdx$", ".md").alias("path")).distinct()
    have = output.select("path").distinct()
    lost = want.join(have, "path", "left_anti").withColumn("side", F.lit("missing"))
    return lost.unionByName(have.join(want, "path", "left_anti").withColumn("side", F.lit("unexpected")))


def same_files(source: DataFrame, output: DataFrame) -> Gate:
    r = unmatched_files(source, output).agg(*(F.count_if(F.col("side") == s).alias(s) for s in ("missing", "unexpected"))).first()
    return Gate("same files", r.missing == 0 and r.unexpected == 0, r.asDict())


def stored_ratio(chunks: DataFrame, stored: DataFrame, least: float = 0.9) -> Gate:
    wanted = chunks.where(filters.should_embed(F.col("token_count"), F.col("doc_path")))
    r = filters.count_ratio(wanted, stored, least).first()
    return Gate("stored vectors", bool(r.enough), r.asDict())


def content_sample(chunks: DataFrame, contents: DataFrame, order: str, most: int = 50) -> Gate:
    """At most a tenth of a systematic sample may be missing from the content store."""
    sample = filters.systematic_sample(chunks.select(order, "content_hash"), order, most)
    n, missing = sample.count(), sample.join(contents.select("content_hash"), "content_hash", "left_anti").count()
    return Gate("content sample", missing <= 0.1 * min(most, n), {"sampled": n, "missing": missing})


def vector_sample(chunks: DataFrame, vectors: DataFrame, order: str, most: int = 10, least: float = 0.9) -> Gate:
    """The first specification vectors carry source_type and product."""
    ids = chunks.where(F.col("doc_path").startswith("api-reference/") & filters.should_embed(F.col("token_count"), F.col("doc_path")))
    ids = ids.orderBy(order).limit(most).select(F.col("content_hash").alias("id"))
    full = (F.coalesce(F.col("metadata")["source_type"], F.lit("")) != "") & (F.coalesce(F.col("metadata")["product"], F.lit("")) != "")
    r = vectors.join(ids.distinct(), "id").agg(F.count("*").alias("fetched"), F.count_if(full).alias("full")).first()
    return Gate("vector sample", r.full >= least * r.fetched, r.asDict())


def before_sync(chunks: DataFrame, least: int = C.MIN_CHUNKS_PRODUCTION) -> list[Gate]:
    return [least_count(chunks, least), required_fields(chunks), hash_format(chunks)]


def after_sync(chunks: DataFrame, vectors: DataFrame, contents: DataFrame, order: str = "content_hash") -> list[Gate]:
    return [stored_ratio(chunks, vectors), content_sample(chunks, contents, order), spec_metadata(chunks), vector_sample(chunks, vectors, order)]
