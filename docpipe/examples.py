"""Five small pipelines over chunk rows, as starting points; embedders and stores are the caller's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import filters, sync
from .sources.stores import Embedder, VectorStore


def embeddable(chunks: DataFrame) -> DataFrame:
    """Chunks that are worth a vector."""
    return chunks.where(filters.should_embed(F.col("token_count"), F.col("doc_path")) & filters.valid_for_embedding())


def labelled_counts(chunks: DataFrame) -> DataFrame:
    """Chunks a label."""
    return chunks.groupBy(filters.embed_label(F.col("token_count"), F.col("doc_path")).alias("label")).agg(F.count("*").alias("chunks"))


def oversized_files(chunks: DataFrame) -> DataFrame:
    """Files with oversized chunks, and how many."""
    return chunks.where(filters.is_oversized(F.col("token_count"))).groupBy("doc_path").agg(F.count("*").alias("oversized"))


def embed_into(chunks: DataFrame, embedder: Embedder, store: VectorStore) -> int:
    """Embed what is worth it and upsert it; the number of vectors."""
    rows = embeddable(chunks).dropDuplicates(["content_hash"])
    made = store.stage(sync.embed(rows, embedder).where("error is null"))
    empty = F.create_map().cast("map<string,string>").alias("metadata")
    store.upsert(made.select(F.col("content_hash").alias("id"), "embedding", empty))
    return made.count()


def copy_texts(chunks: DataFrame, put: Callable[[str, str, dict], None], existing: DataFrame) -> int:
    """Put the texts of a run where a reader of hits finds them."""
    return sync.upload_gate(sync.upload(chunks, put, existing))
