"""Command line: python -m docpipe.cli COMMAND ... (ingest, normalize-pages, normalize-specs,
upload-content, check-token-limits, smoke-test, sync, verify)."""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config as C
from .functions import tokens
from .operators import apispec, sync, validate
from .plans import pipeline
from .sources import files, sinks, state, stores


def _chunks(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/chunks")


def _specs(spark: SparkSession, folder: str | None) -> DataFrame | None:
    return files.read_specs(spark, folder).select("path", "text") if folder else None


def ingest(spark: SparkSession, a: argparse.Namespace) -> dict:
    pages = files.read_pages(spark, C.ScanConfig(a.pages)).select("doc_path", "text")
    counter = tokens.BpeCounter(a.vocabulary) if a.vocabulary else None
    row = pipeline.run(spark, pages, _specs(spark, a.specs), a.out, state.git_facts(a.repo), a.full, a.by_revision, counter).first()
    if a.export:
        sinks.write_json_export(_chunks(spark, a.out), a.export, row.asDict())
    return row.asDict()


def normalize_pages(spark: SparkSession, a: argparse.Namespace) -> dict:
    pages = files.read_pages(spark, C.ScanConfig(a.pages)).select("doc_path", "text")
    pipeline.page_bodies(pages).write.mode("overwrite").parquet(f"{a.out}/pages")
    rows = spark.read.parquet(f"{a.out}/pages")
    done = sinks.write_pages(rows, f"{a.out}/normalized")
    errors = [r.asDict() for r in done.where("error is not null").limit(20).collect()]
    gate = validate.same_files(pages, done.where("error is null"))
    return {"pages": rows.count(), "passed": gate.passed, "errors": errors}


def normalize_specs(spark: SparkSession, a: argparse.Namespace) -> dict:
    apispec.spec_files(_specs(spark, a.specs)).write.mode("overwrite").parquet(f"{a.out}/specs")
    rows = spark.read.parquet(f"{a.out}/specs")
    good = rows.where("error is null").select(F.col("out_path").alias("path"), F.col("markdown").alias("text"))
    done = sinks.write_files(good, f"{a.out}/specifications", clean=True)  # files of specifications that are gone go
    bad = rows.where("error is not null").select("path", "error").unionByName(done.where("error is not null"))
    return {"files": done.where("error is null").count(), "errors": [r.asDict() for r in bad.limit(20).collect()]}


def upload_content(spark: SparkSession, a: argparse.Namespace) -> dict:
    return {"uploaded": stores.ParquetContentStore(spark, f"{a.out}/content").upload(_chunks(spark, a.out))}


def _report(gates: list[validate.Gate]) -> dict:
    return {"passed": all(g.passed for g in gates), "gates": [vars(g) for g in gates]}


def check_token_limits(spark: SparkSession, a: argparse.Namespace) -> dict:
    rows = spark.read.parquet(f"{a.out}/specs").where("error is null")
    return _report([validate.token_ceiling(rows, path="out_path")])


def smoke_test(spark: SparkSession, a: argparse.Namespace) -> dict:
    chunks = _chunks(spark, a.out)
    spec = chunks.where(F.col("doc_path").startswith("api-reference/"))
    gates = [validate.least_count(chunks, a.least), validate.required_fields(chunks), validate.hash_format(chunks), validate.spec_metadata(chunks)]
    return _report(gates + ([validate.token_ceiling(spec, C.SPEC_FILE_LIMIT, "doc_path")] if not spec.isEmpty() else []))


def run_sync(spark: SparkSession, a: argparse.Namespace) -> dict:
    chunks = _chunks(spark, a.out)
    gates = validate.before_sync(chunks, a.least)
    if not all(g.passed for g in gates):
        return _report(gates)
    store = stores.ParquetVectorStore(spark, f"{a.out}/vectors")
    if not a.dry_run:
        stores.ParquetContentStore(spark, f"{a.out}/content").upload(chunks)
        store.backup(f"{a.out}/backup")
    old = store.vectors(spark).select(F.col("id").alias("content_hash"))
    meta = F.map_filter(F.create_map(*(x for k in validate.SPEC_KEYS for x in (F.lit(k), F.col(f"metadata.{k}")))), lambda _, v: v.isNotNull())
    fields = {"doc_path": F.col("doc_path"), "section": F.col("section"), "url": F.col("url"), "section_path": F.to_json("section_path")}
    rows = chunks.select("content_hash", "content", "token_count", "doc_path", sync.vector_metadata(meta, fields).alias("metadata"), F.xxhash64("doc_path").alias("file_seq"), "chunk_seq")
    facts = state.git_facts(a.repo)

    def save(kept: stores.ParquetVectorStore) -> None:
        """The head of the state; the hashes themselves are the store's ids."""
        state.save_state(f"{a.out}/sync-state.json", state.SyncState(facts["commit_sha"], set(), kept.count(), time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())))

    last = state.load_state(f"{a.out}/sync-state.json").last_synced
    r = sync.sync(rows, old, store, stores.HashEmbedder(), a.dry_run, save=save)
    figures = {k: v for k, v in vars(r).items() if k != "hashes"}
    return {"passed": True, "last_synced": last} | figures


def verify(spark: SparkSession, a: argparse.Namespace) -> dict:
    store = stores.ParquetVectorStore(spark, f"{a.out}/vectors")
    return _report(validate.after_sync(_chunks(spark, a.out), store.vectors(spark), stores.ParquetContentStore(spark, f"{a.out}/content").contents()))


COMMANDS = {
    "ingest": ingest,
    "normalize-pages": normalize_pages,
    "normalize-specs": normalize_specs,
    "upload-content": upload_content,
    "check-token-limits": check_token_limits,
    "smoke-test": smoke_test,
    "sync": run_sync,
    "verify": verify,
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="docpipe")
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("--pages", help="folder of pages")
    p.add_argument("--specs", help="folder of API specifications")
    p.add_argument("--out", required=True, help="folder of the results")
    p.add_argument("--repo", default=".", help="git working tree, for revision facts")
    p.add_argument("--least", type=int, help="chunks that must be there")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--full", action="store_true", help="ingest all files, whatever the last run has")
    p.add_argument("--by-revision", action="store_true", help="ingest all files if the revision changed")
    p.add_argument("--vocabulary", help="file of a BPE vocabulary to count tokens with")
    p.add_argument("--export", help="write all chunks to this file as one JSON document")
    a = p.parse_args(argv)
    if a.least is None:
        a.least = C.MIN_CHUNKS_SMOKE if a.command == "smoke-test" else C.MIN_CHUNKS_PRODUCTION
    out = COMMANDS[a.command](spark or SparkSession.builder.appName("docpipe").getOrCreate(), a)
    print(json.dumps(out, default=str))
    return 0 if out.get("passed", True) else 1


if __name__ == "__main__":
    sys.exit(main())

