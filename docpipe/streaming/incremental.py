"""Ingestion as a stream of changes: files that are new, changed or gone since the last run.

A file source remembers paths, not contents, so files are not streamed
themselves. Each run takes a listing: path and hash of every file, and a row
without a hash for each path of the last listing that is gone. Listings are the
stream, and the state too: what a batch is compared with is the listing before its
first, joined by path, so no path costs a call of Python. A batch reads the pages
that changed and writes their chunks, and the changes with them, to a folder named
by the batch, so a batch that is run again after a failure replaces itself. Several
listings in one batch (after a lost run) are taken as one step from the state before
them to the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import ScanConfig
from ..plans.pipeline import file_hashes, ingest
from ..sources.files import exists, read_pages

LISTING = "doc_path string, file_hash string, run long"


def last_listing(spark: SparkSession, listings: str) -> DataFrame | None:
    """The files of the newest listing, or None before the first."""
    if not exists(spark, listings):
        return None
    rows = spark.read.schema(LISTING).option("recursiveFileLookup", True).parquet(listings)
    run = rows.agg(F.max("run")).first()[0]
    return None if run is None else rows.where((F.col("run") == run) & F.col("file_hash").isNotNull())


def take_listing(files: DataFrame, listings: str) -> int:
    """Add a listing of files (doc_path, file_hash) to the folder; its number.

    An empty folder of files is a listing too: all that was there is gone.
    """
    spark = files.sparkSession
    last = last_listing(spark, listings)
    run = 0
    rows = files.select("doc_path", "file_hash")
    if last is not None:
        run = (spark.read.schema(LISTING).option("recursiveFileLookup", True).parquet(listings).agg(F.max("run")).first()[0]) + 1
        gone = last.join(rows, "doc_path", "left_anti").select("doc_path", F.lit(None).cast("string").alias("file_hash"))
        rows = rows.unionByName(gone)
    rows.withColumn("run", F.lit(run).cast("long")).write.parquet(f"{listings}/listing-{run}")
    return run


def changes_of(batch: DataFrame, listings: str) -> DataFrame:
    """(doc_path, action, file_hash, run): the last state of each path of a batch against the listing before it; nothing if it comes out as it was."""
    spark = batch.sparkSession
    first = batch.agg(F.min("run")).first()[0]
    last = batch.groupBy("doc_path").agg(F.max(F.struct("run", "file_hash")).alias("x")).select("doc_path", "x.*")
    if first:
        old = spark.read.schema(LISTING).parquet(f"{listings}/listing-{first - 1}").where("file_hash is not null")
        last = last.join(old.groupBy("doc_path").agg(F.max("file_hash").alias("before")), "doc_path", "left")
    else:
        last = last.withColumn("before", F.lit(None).cast("string"))
    action = F.when(F.col("file_hash").isNull(), "removed").when(F.col("before").isNull(), "new").otherwise("changed")
    return last.where(~F.col("file_hash").eqNullSafe(F.col("before"))).select("doc_path", action.alias("action"), "file_hash", "run")


def change_stream(spark: SparkSession, listings: str, checkpoint: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Start the stream over the listings there are; write takes the new, changed and removed paths of a batch, and its number."""
    stream = spark.readStream.schema(LISTING).option("recursiveFileLookup", True).parquet(listings)
    each = lambda batch, number: write(changes_of(batch, listings), number)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_changes(
    spark: SparkSession, pages: DataFrame, work: str, git: dict[str, str] | None = None, normalize: bool = True
) -> StreamingQuery:
    """Take a listing of pages (doc_path, text), and ingest what changed since the last one below work.

    pages is read twice, for the hashes and for the changed texts; a page that
    changes in between is ingested as it is then, and again by the next run.
    """
    take_listing(file_hashes(pages), f"{work}/listings")

    def write(found: DataFrame, number: int) -> None:
        found.write.mode("overwrite").parquet(f"{work}/changes/batch={number}")
        changes = spark.read.parquet(f"{work}/changes/batch={number}")
        chunks, _ = ingest(pages.join(changes.where("action <> 'removed'"), "doc_path", "left_semi"), git, normalize=normalize)
        chunks.write.mode("overwrite").parquet(f"{work}/chunks/batch={number}")

    return change_stream(spark, f"{work}/listings", f"{work}/checkpoint", write)


def ingest_folder(spark: SparkSession, root: str, work: str, git: dict[str, str] | None = None, cfg: ScanConfig | None = None) -> StreamingQuery:
    """ingest_changes of the pages below a folder."""
    return ingest_changes(spark, read_pages(spark, cfg or ScanConfig(root)).select("doc_path", "text"), work, git)


def changes(spark: SparkSession, work: str) -> DataFrame:
    """All changes so far: doc_path, action, file_hash, run, batch."""
    return spark.read.option("basePath", f"{work}/changes").parquet(f"{work}/changes")


def latest_chunks(spark: SparkSession, work: str) -> DataFrame:
    """The chunks that hold now: of each path, those of the batch of its last change, unless that removed it.

    A file that has no chunks any more has none here either.
    """
    last = changes(spark, work).groupBy("doc_path").agg(F.max(F.struct("batch", "action")).alias("x")).where("x.action <> 'removed'")
    rows = spark.read.parquet(f"{work}/chunks")
    return rows.join(last.select("doc_path", "x.batch"), ["doc_path", "batch"]).drop("batch")
