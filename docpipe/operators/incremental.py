"""Incremental ingestion as set algebra: which files to read, how runs merge, how runs compare."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import keep_last


def files_to_process(current: DataFrame, previous: DataFrame | None, sha: str, previous_sha: str | None) -> DataFrame:
    """(doc_path, file_hash?, action): all files if the revision changed or is unknown, else new and changed ones.

    `previous` and `current` hold doc_path and file_hash; files that are gone get `deleted`.
    """
    if previous is None or sha != previous_sha or sha == "unknown":
        out = current.withColumn("action", F.lit("process"))
        if previous is None:
            return out.select("doc_path", "action")
        gone = previous.select("doc_path").distinct().join(current, "doc_path", "left_anti").withColumn("action", F.lit("deleted"))
        return out.select("doc_path", "action").unionByName(gone.select("doc_path", "action"))
    old = previous.groupBy("doc_path").agg(F.max("file_hash").alias("old_hash"))
    both = current.select("doc_path", "file_hash").join(old, "doc_path", "full_outer")
    action = (
        F.when(F.col("file_hash").isNull(), "deleted")
        .when(F.col("old_hash").isNull() | (F.col("old_hash") != F.col("file_hash")), "process")
        .otherwise("skip")
    )
    return both.select("doc_path", action.alias("action"))


def classify(new: DataFrame, previous: DataFrame, order: str) -> DataFrame:
    """new rows with status new, updated or unchanged against the last previous row of their id."""
    old = keep_last(previous.select("chunk_id", "content_hash", order), "chunk_id", order)
    old = old.select("chunk_id", F.col("content_hash").alias("old_hash"))
    status = F.when(F.col("old_hash").isNull(), "new").when(F.col("old_hash") != F.col("content_hash"), "updated").otherwise("unchanged")
    return new.join(old, "chunk_id", "left").withColumn("status", status).drop("old_hash")


def merge_chunks(new: DataFrame, previous: DataFrame, processed: DataFrame, order: str, current: DataFrame | None = None) -> DataFrame:
    """New chunks, and previous ones of files that were not processed and whose id is not new.

    With `current` (doc_path of the files that exist) chunks of deleted files go;
    without it they stay.
    """
    fresh = classify(new, previous, order)
    old = keep_last(previous, "chunk_id", order).join(processed.select("doc_path").distinct(), "doc_path", "left_anti")
    old = old.join(new.select("chunk_id").distinct(), "chunk_id", "left_anti")
    if current is not None:
        old = old.join(current.select("doc_path").distinct(), "doc_path", "left_semi")
    return fresh.unionByName(old.withColumn("status", F.lit("kept")), allowMissingColumns=True)


def by_file(chunks: DataFrame, *order: str) -> DataFrame:
    """(doc_path, chunks): the rows of each file in order, as an array."""
    rest = [c for c in chunks.columns if c != "doc_path" and c not in order]
    return chunks.groupBy("doc_path").agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias("chunks"))


def carry_over(new: DataFrame, kept: DataFrame, previous: DataFrame, todo: DataFrame, order: str = "chunk_seq") -> DataFrame:
    """New chunks with their status against the previous run, and all previous chunks of files that are skipped.

    todo: files_to_process; rows of new that have a status keep it. Files of which
    nothing is known (neither current nor previous) go.
    """
    fresh = classify(new.withColumnRenamed("status", "__given"), previous, order)
    fresh = fresh.withColumn("status", F.coalesce("__given", "status")).drop("__given")
    same = todo.where("action = 'skip'").select("doc_path").distinct()
    return fresh.unionByName(kept.join(same, "doc_path", "left_semi").withColumn("status", F.lit("kept")), allowMissingColumns=True)


def compare_runs(a: DataFrame, b: DataFrame, order: str) -> DataFrame:
    """One row: added, removed, modified, unchanged chunk ids from a to b."""
    left = keep_last(a.select("chunk_id", "content_hash", order), "chunk_id", order).select("chunk_id", F.col("content_hash").alias("h1"))
    right = keep_last(b.select("chunk_id", "content_hash", order), "chunk_id", order).select("chunk_id", F.col("content_hash").alias("h2"))
    both = left.join(right, "chunk_id", "full_outer")
    return both.agg(
        F.count_if(F.col("h1").isNull()).alias("added"),
        F.count_if(F.col("h2").isNull()).alias("removed"),
        F.count_if(F.col("h1") != F.col("h2")).alias("modified"),
        F.count_if(F.col("h1") == F.col("h2")).alias("unchanged"),
    )


def validate_unchanged(old: DataFrame, new: DataFrame, files: DataFrame, order: str) -> DataFrame:
    """One row `ok`: every previous chunk of the files is still there with the same hash."""
    kept = old.join(files.select("doc_path").distinct(), "doc_path", "left_semi")
    after = keep_last(new.select("chunk_id", "content_hash", order), "chunk_id", order).select("chunk_id", F.col("content_hash").alias("now"))
    same = F.coalesce(F.col("now") == F.col("content_hash"), F.lit(False))
    return kept.join(after, "chunk_id", "left").agg(F.coalesce(F.bool_and(same), F.lit(True)).alias("ok"))


def replace_prefix(old: DataFrame, new: DataFrame, prefix: str) -> DataFrame:
    """Rows below a path prefix replaced by new ones."""
    return old.where(~F.col("doc_path").startswith(prefix)).unionByName(new)


def chunks_equal(a: str, b: str) -> Column:
    """Whether the rows under two aliases are the same chunk: hash, path and section."""
    same = (F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in ("content_hash", "doc_path", "section"))
    return reduce(lambda x, y: x & y, same)
