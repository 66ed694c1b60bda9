"""Vector synchronisation: plan by content hash, embed what is new, refresh, remove, keep state."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..scratch import settled
from ..shipping import ship
from ..sources.stores import Embedder, VectorStore
from .ranking import keep_first


def sync_plan(current: DataFrame, state: DataFrame) -> DataFrame:
    """(content_hash, op): insert, update or delete, from one full outer join."""
    now = current.select("content_hash").distinct().withColumn("now", F.lit(True))
    old = state.select("content_hash").distinct().withColumn("old", F.lit(True))
    op = F.when(F.col("old").isNull(), "insert").when(F.col("now").isNull(), "delete").otherwise("update")
    return now.join(old, "content_hash", "full_outer").select("content_hash", op.alias("op"))


def vector_metadata(chunk_metadata: Column, fields: dict[str, Column]) -> Column:
    """Fixed fields as a string map, with the chunk's own metadata over them."""
    own = F.coalesce(chunk_metadata, F.create_map().cast("map<string,string>"))
    names = F.array(*(F.lit(k) for k in fields))
    fixed = F.map_from_arrays(names, F.array(*(c.cast("string") for c in fields.values())))
    kept = F.map_filter(fixed, lambda k, _: ~F.map_contains_key(own, k))
    return F.map_concat(kept, own)


def upload_plan(chunks: DataFrame, existing: DataFrame) -> DataFrame:
    """(content_hash, action): upload or skip, each hash once."""
    return (
        chunks.select("content_hash")
        .distinct()
        .join(existing.select("content_hash").distinct().withColumn("there", F.lit(True)), "content_hash", "left")
        .select("content_hash", F.when(F.col("there"), "skip").otherwise("upload").alias("action"))
    )


def metadata_refresh(updates: DataFrame, vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(updates with their stored embedding, updates without one)."""
    stored = vectors.select(F.col("id").alias("content_hash"), "embedding")
    return updates.join(stored, "content_hash"), updates.join(stored, "content_hash", "left_anti")


def retry(call: Callable[[], object], tries: int = 3, base_ms: int = 1000, sleep: Callable[[float], None] = time.sleep, transient: Callable[[Exception], bool] = lambda e: True):
    """Call again after base * 2^n ms; what is not transient, and the last failure, is raised."""
    for n in range(tries):
        try:
            return call()
        except Exception as e:
            if n == tries - 1 or not transient(e):
                raise
            sleep(base_ms * 2**n / 1000)


class BatchWriter:
    """Writes batches with retries; isolated failures are counted, C.BREAKER in a row stop the run."""

    def __init__(self, write: Callable[[list], None], size: int = C.STAGE_SIZE, sleep: Callable[[float], None] = time.sleep):
        self.write, self.size, self.sleep = write, size, sleep
        self.failed: list = []
        self.written: list = []
        self._row = 0

    def run(self, rows: Iterable) -> None:
        batch: list = []
        for row in rows:
            batch.append(row)
            if len(batch) == self.size:
                self._one(batch)
                batch = []
        if batch:
            self._one(batch)

    def _one(self, batch: list) -> None:
        try:
            retry(lambda: self.write(batch), sleep=self.sleep)
            self.written += batch
            self._row = 0
        except Exception as e:
            self.failed += batch
            self._row += 1
            if self._row >= C.BREAKER:
                raise RuntimeError(f"{self._row} batches in a row failed") from e


def _embed_rows(embedder: Embedder):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            vectors, errors, calls = [], [], []
            for text in pdf.content:
                before = getattr(embedder, "calls", 0)
                try:
                    vectors.append(embedder.embed(text))
                    errors.append(None)
                except Exception as e:  # a failed chunk is reported and left out
                    vectors.append(None)
                    errors.append(str(e)[:200])
                calls.append(max(1, getattr(embedder, "calls", 0) - before))
            yield pd.DataFrame({"content_hash": pdf.content_hash, "embedding": vectors, "error": errors, "calls": calls})

    return run


def embed(chunks: DataFrame, embedder: Embedder, workers: int | None = None) -> DataFrame:
    """(content_hash, embedding, error, calls of the model).

    At most `workers` calls at a time, by default those that the embedder names
    (hosted models limit callers); without a limit rows stay where they are.
    """
    ship(chunks.sparkSession)
    rows = chunks.select("content_hash", "content")
    workers = workers or getattr(embedder, "workers", None)
    if workers:
        rows = rows.repartition(workers)
    return rows.mapInPandas(_embed_rows(embedder), "content_hash string, embedding array<float>, error string, calls int")


def upload(chunks: DataFrame, put: Callable[[str, str, dict], None], existing: DataFrame, batch: int = 10, tries: int = 3, base_ms: int = 500) -> DataFrame:
    """(content_hash, error) of texts that are not there yet, each once, put by the executors.

    `batch` calls run side by side and all of them are settled before the next;
    each has `tries`. `put` takes hash, text and the object's facts. The table is
    settled, so reading it again uploads nothing.
    """
    new = keep_first(chunks.select("content_hash", "content", "doc_path", "source_repo", "commit_sha"), "content_hash", "doc_path")
    new = new.join(existing.select("content_hash").distinct(), "content_hash", "left_anti")
    ship(chunks.sparkSession)

    def one(row) -> str | None:
        facts = {"doc-path": row.doc_path, "source-repo": row.source_repo, "commit-sha": row.commit_sha}
        try:
            retry(lambda: put(row.content_hash, row.content, facts), tries, base_ms)
        except Exception as e:
            return str(e)[:200] or type(e).__name__
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(batch) as pool:
            for pdf in batches:
                rows, errors = list(pdf.itertuples(index=False)), []
                for a in range(0, len(rows), batch):
                    errors += list(pool.map(one, rows[a : a + batch]))
                yield pd.DataFrame({"content_hash": pdf.content_hash, "error": errors})

    return settled(new.mapInPandas(run, "content_hash string, error string"))


def upload_gate(done: DataFrame) -> int:
    """The number of uploads; RuntimeError if any failed."""
    r = done.agg(F.count("*").alias("n"), F.count("error").alias("bad"), F.max("error").alias("error")).first()
    if r.bad:
        raise RuntimeError(f"{r.bad} of {r.n} uploads failed: {r.error}")
    return r.n


def failure_gate(embedded: DataFrame, share: float = C.FAILURE_SHARE) -> DataFrame:
    """Per stage: ok, failed, and whether failures pass the share of successes."""
    return (
        embedded.groupBy("stage")
        .agg(F.count_if(F.col("error").isNull()).alias("ok"), F.count_if(F.col("error").isNotNull()).alias("failed"))
        .withColumn("abort", F.col("failed") > share * F.col("ok"))
    )


def stages(rows: DataFrame, order: str, size: int = C.STAGE_SIZE) -> DataFrame:
    from .ranking import with_rank

    return with_rank(rows, order).withColumn("stage", F.floor(F.col("rank") / size).cast("int"))


def planned(wanted: DataFrame, state: DataFrame) -> DataFrame:
    """(content_hash, op, content, metadata): sync_plan with the first row of each hash by file_seq and chunk_seq; null for deletes.

    One aggregate over both tables, so texts are shuffled once. Rows without a hash have no place in a store.
    """
    now = wanted.select("content_hash", F.struct("content", "metadata").alias("row"), F.struct("file_seq", "chunk_seq").alias("at"), F.lit(False).alias("old"))
    both = now.unionByName(state.select("content_hash", F.lit(True).alias("old")), allowMissingColumns=True).where("content_hash is not null")
    found = both.groupBy("content_hash").agg(F.min_by("row", "at").alias("row"), F.count("at").alias("n"), F.bool_or("old").alias("old"))
    op = F.when(~F.col("old"), "insert").when(F.col("n") == 0, "delete").otherwise("update")
    return found.select("content_hash", op.alias("op"), "row.*")


def stage_ranges(hashes: DataFrame, n: int, size: int) -> list[Column]:
    """A condition for each stage of `size` of n distinct hashes, in their order; only the first hashes of the stages are collected."""
    from .ranking import with_rank

    h = F.col("content_hash")
    if n <= size:
        return [h.isNotNull()] if n else []
    ranked = with_rank(hashes.select("content_hash"), "content_hash")
    first = [r[0] for r in ranked.where(F.col("rank") % size == 0).orderBy("rank").select("content_hash").collect()]
    return [(h >= a) & (h < b) for a, b in zip(first, first[1:])] + [h >= first[-1]]


@dataclass
class SyncResult:
    plan: dict[str, int]
    written: int
    failed: int
    refreshed: int
    deleted: int
    hashes: DataFrame
    stages: int = 0
    calls: int = 0


def sync(
    chunks: DataFrame,
    state: DataFrame,
    store: VectorStore,
    embedder: Embedder,
    dry_run: bool = False,
    stage_size: int = C.STAGE_SIZE,
    most_stages: int = 50,
    save: Callable[[VectorStore], None] | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> SyncResult:
    """One run in stages: embed, check the stage's failures, upsert, then save the state.

    chunks: content_hash, content, token_count, doc_path, metadata, file_seq,
    chunk_seq. A stage holds `stage_size` chunks, or more so that there are at most
    `most_stages`. What a stage has stored is in the store's ids, so a run that was
    lost goes on after its last whole stage and embeds nothing twice but that one.
    Writes have three tries; a stage that can't be written counts as failed, and
    C.BREAKER of them in a row stop the run. Deletes that fail stop it at once.
    """
    from .filters import should_embed

    spark = chunks.sparkSession
    plan = planned(chunks.where(should_embed(F.col("token_count"), F.col("doc_path"))), state).persist()
    try:
        counts = {r["op"]: r["count"] for r in plan.groupBy("op").count().collect()}
        of = lambda op: plan.where(F.col("op") == op)
        if dry_run:
            return SyncResult(counts, 0, 0, 0, 0, state.select("content_hash"))
        result = SyncResult(counts, 0, 0, 0, 0, state)
        n = counts.get("insert", 0)
        fresh = of("insert")
        broken = 0
        for k, in_stage in enumerate(stage_ranges(fresh, n, max(stage_size, -(-n // most_stages)))):
            made = store.stage(embed(fresh.where(in_stage), embedder))
            meta = fresh.where(in_stage).select("content_hash", "metadata")
            r = made.agg(F.count_if(F.col("error").isNull()).alias("ok"), F.count("error").alias("bad"), F.sum("calls").alias("calls")).first()
            result.calls += r.calls or 0
            result.failed += r.bad
            if r.bad > C.FAILURE_SHARE * r.ok:
                raise RuntimeError(f"{r.bad} of {r.ok + r.bad} embeddings failed in stage {k}")
            rows = made.where("error is null").join(meta, "content_hash").select(F.col("content_hash").alias("id"), "embedding", "metadata")
            try:
                retry(lambda rows=rows: store.upsert(rows), sleep=sleep)
                result.written += r.ok
                broken = 0
            except Exception as e:
                result.failed += r.ok
                broken += 1
                if broken >= C.BREAKER:
                    raise RuntimeError(f"{broken} stages in a row could not be written") from e
            store.unstage()
            result.stages += 1
            if save:
                save(store)
        kept, _ = metadata_refresh(of("update").select("content_hash", "metadata"), store.vectors(spark))
        if counts.get("update"):
            result.refreshed = kept.count()
            retry(lambda: store.upsert(kept.select(F.col("content_hash").alias("id"), "embedding", "metadata")), sleep=sleep)
        if counts.get("delete"):
            retry(lambda: store.delete(of("delete").select(F.col("content_hash").alias("id"))), sleep=sleep)
            result.deleted = counts["delete"]
        if save:
            save(store)
        result.hashes = store.vectors(spark).select(F.col("id").alias("content_hash"))
        return result
    finally:
        store.unstage()
        plan.unpersist()
