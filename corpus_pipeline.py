"""The corpus pipeline: stages over `documents`, each written and read again.

quality classifier > MinHash near-dedup > substring dedup > benchmark
decontamination > best-fit packing. All but the last return the columns of the
documents they get. A null doc_id passes the two dedup stages untouched; an empty
table passes all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docpipe.llm._store import Scratch
from docpipe.llm.decontam import keep_clean
from docpipe.llm.neardup import keep_first
from docpipe.llm.packing import pack_documents
from docpipe.llm.quality import keep_good
from docpipe.llm.queries import table, tokenizer_path
from docpipe.llm.substrings import cut_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, on five-word shingles at 0.8."""
    return keep_first(docs, width=5, percent=80)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that an earlier document holds."""
    return cut_repeats(docs, min_words=50)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return pack_documents(docs, tokenizer_path(), length=2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, applied to the documents table."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if i == len(STAGES) - 1 else scratch.save(out)
    return docs
