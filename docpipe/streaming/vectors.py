"""Vector synchronisation as a stream of chunk files: embedded once, stored once.

Each micro-batch is a stage. Its vectors are first written to a folder named by the
batch number, then put into the store, then the folder goes; the checkpoint holds
what is done. A batch that is run again after a failure keeps its number, so it
finds its folder if that is whole, and embeds nothing twice; if the run was lost
while embedding, that one batch is embedded again. Texts that the store has already
(of this stream or of another run) are not embedded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import config as C
from ..operators.filters import should_embed
from ..operators.ranking import keep_first
from ..operators.sync import embed
from ..shipping import ship
from ..sources.files import exists
from ..sources.stores import Embedder, ParquetVectorStore

COLUMNS = ("content_hash", "content", "token_count", "doc_path", "metadata", "chunk_seq")


def stage_batch(batch: DataFrame, number: int, store: ParquetVectorStore, embedder: Embedder, share: float = C.FAILURE_SHARE) -> None:
    """One stage: embed what the store lacks, check its failures, upsert, drop the stage's folder."""
    spark = batch.sparkSession
    name = f"staged-batch-{number}"
    path = f"{store.root}/{name}"
    if not exists(spark, f"{path}/_SUCCESS"):
        wanted = keep_first(batch.where(should_embed(F.col("token_count"), F.col("doc_path"))).select(*COLUMNS), "content_hash", "doc_path", "chunk_seq")
        have = store.vectors(spark).select(F.col("id").alias("content_hash"))
        new = wanted.join(have, "content_hash", "left_anti").select("content_hash", "content", "metadata")
        made = embed(new, embedder).join(new.select("content_hash", "metadata"), "content_hash")
        made.write.mode("overwrite").parquet(path)
    made = spark.read.parquet(path)
    r = made.agg(F.count_if(F.col("error").isNull()).alias("ok"), F.count("error").alias("bad")).first()
    if r.bad > share * r.ok:
        store.table.remove(name)  # the next try embeds again
        raise RuntimeError(f"{r.bad} of {r.ok + r.bad} embeddings failed in batch {number}")
    store.upsert(made.where("error is null").select(F.col("content_hash").alias("id"), "embedding", "metadata"))
    store.table.remove(name)


def sync_stream(spark: SparkSession, chunks: str, store: ParquetVectorStore, embedder: Embedder, checkpoint: str, files: int = 8) -> StreamingQuery:
    """Put the chunks of the Parquet files below a folder into the store, `files` of them a batch, as far as there are any."""
    ship(spark)
    schema = spark.read.option("recursiveFileLookup", True).parquet(chunks).select(*COLUMNS).schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files).parquet(chunks)
    write = lambda batch, number: stage_batch(batch, number, store, embedder)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def prune(spark: SparkSession, store: ParquetVectorStore, chunks: DataFrame) -> int:
    """Remove the vectors of texts that no chunk holds any more; their number."""
    gone = store.vectors(spark).select("id").join(chunks.select(F.col("content_hash").alias("id")), "id", "left_anti")
    n = gone.count()
    if n:
        store.delete(gone)
    return n
