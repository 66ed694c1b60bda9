"""Embedders and keyed stores: small protocols with offline defaults over Parquet."""

from __future__ import annotations

import hashlib
import math
import random
import struct
import time
import uuid
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from ..config import VECTOR_SIZE
from .buckets import BucketedTable

VECTOR_SCHEMA = "id string, embedding array<float>, metadata map<string,string>"


class Embedder(Protocol):
    def embed(self, text: str) -> list[float]: ...


class HashEmbedder:
    """A vector of length one that depends on the text alone."""

    def __init__(self, size: int = VECTOR_SIZE):
        self.size = size

    def embed(self, text: str) -> list[float]:
        raw = hashlib.shake_256(text.encode()).digest(4 * self.size)
        values = [v / 2**31 - 1.0 for v in struct.unpack(f"<{self.size}I", raw)]
        norm = math.sqrt(sum(v * v for v in values)) or 1.0
        return [v / norm for v in values]


class PatientEmbedder:
    """Another embedder with a pause between calls, and retries of transient errors.

    Waits are 50 to 100 % of min(1 s * 2^n, 16 s), the share drawn at random. A copy
    works in each of at most `workers` tasks; its calls are counted per row by `embed`.
    """

    def __init__(self, inner: Embedder, tries: int = 5, gap_ms: int = 0, transient=None, sleep=time.sleep, share=random.random, workers: int = 5):
        self.inner, self.tries, self.gap_ms, self.sleep, self.share = inner, tries, gap_ms, sleep, share
        self.transient = transient or throttled
        self.calls = 0
        self.workers = workers

    def embed(self, text: str) -> list[float]:
        for n in range(self.tries):
            if self.calls and self.gap_ms:
                self.sleep(self.gap_ms / 1000)
            self.calls += 1
            try:
                return self.inner.embed(text)
            except Exception as e:
                if n == self.tries - 1 or not self.transient(e):
                    raise
                self.sleep(min(2**n, 16) * (0.5 + 0.5 * self.share()))
        raise ValueError("tries must be positive")


def throttled(e: Exception) -> bool:
    """Errors that go away: throttling, and status 429 or above 499."""
    status = getattr(e, "status", None) or getattr(e, "status_code", None)
    return "thrott" in f"{type(e).__name__} {e}".lower() or (isinstance(status, int) and (status == 429 or status >= 500))


def mock_vector(size: int = VECTOR_SIZE):
    return F.array_repeat(F.lit(0.0).cast("float"), size)


class VectorStore(Protocol):
    def vectors(self, spark: SparkSession) -> DataFrame: ...
    def stage(self, rows: DataFrame) -> DataFrame: ...
    def unstage(self) -> None: ...
    def upsert(self, rows: DataFrame) -> None: ...
    def delete(self, ids: DataFrame) -> None: ...


def upserted(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """old with the rows of new in place of those with their key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def deleted(old: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return old.join(ids.select(key).distinct(), key, "left_anti")


class ParquetVectorStore:
    """Vectors in a BucketedTable: a write costs the buckets it touches, and old files go after a grace time."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, most_changes: int = 8, grace: float = 3600.0):
        self.spark = spark
        self.table = BucketedTable(spark, root, _parse_datatype_string(VECTOR_SCHEMA), "id", buckets, most_changes, grace)
        self.root = self.table.root
        self._staged: list[str] = []

    def vectors(self, spark: SparkSession) -> DataFrame:
        return self.table.rows()

    def stage(self, rows: DataFrame) -> DataFrame:
        """rows as they are now, written in the store's folder until `unstage`."""
        self._staged.append(f"staged-{uuid.uuid4().hex}")
        path = f"{self.root}/{self._staged[-1]}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def unstage(self) -> None:
        """Remove what this process has staged; after the rows are in the store, or were given up."""
        for name in self._staged:
            self.table.remove(name)
        self._staged.clear()

    def upsert(self, rows: DataFrame) -> None:
        self.table.write(rows.select("id", "embedding", "metadata", F.lit(False).alias("gone")))

    def delete(self, ids: DataFrame) -> None:
        gone = ids.select("id", F.lit(None).cast("array<float>").alias("embedding"), F.lit(None).cast("map<string,string>").alias("metadata"), F.lit(True).alias("gone"))
        self.table.write(gone)

    def fetch(self, ids: DataFrame, values: bool = True) -> DataFrame:
        out = self.vectors(self.spark).join(ids.select("id").distinct(), "id")
        return out if values else out.select("id", "metadata")

    def count(self) -> int:
        return self.vectors(self.spark).count()

    def backup(self, path: str) -> None:
        """Ids and metadata only; if they can't be written, at least the figures of the store."""
        try:
            self.vectors(self.spark).select("id", "metadata").write.mode("overwrite").json(path)
        except Exception as e:
            stats = self.spark.createDataFrame([(self.count(), str(e)[:200])], "vectors long, error string")
            stats.write.mode("overwrite").json(f"{path}-stats")


class ParquetContentStore:
    """Texts by content hash, written once each."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def contents(self) -> DataFrame:
        schema = "content_hash string, content string, doc_path string, source_repo string, commit_sha string"
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        if not target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.root)

    def upload(self, chunks: DataFrame) -> int:
        """Add texts whose hash is not there yet, each once; the number added."""
        from ..operators.ranking import keep_first

        have = self.contents().select("content_hash")
        new = keep_first(chunks.select(*self.contents().columns), "content_hash", "doc_path").join(have, "content_hash", "left_anti")
        before = have.count()
        new.write.mode("append").parquet(self.root)
        return self.contents().count() - before
