"""The registered queries of the subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..shipping import spread
from .balltree import CLUSTER_SQL, cluster_digest
from .decontam import CONTAMINATION_SQL, contamination_digest
from .langid import predict_languages
from .media import media_digest
from .neardup import near_duplicates
from .packing import pack_documents
from .quality import quality
from .secretscan import secret_digest
from .substrings import repeated_passages
from .tokencount import token_counts
from .toxicity import toxicity
from .urlfilter import URL_SQL, url_verdicts
from .whitening import whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table, over all cores."""
    return spread(table(spark, sf_dir, "documents"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality scores of all documents."""
    return quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text stored as WAV samples, and of its spectral fingerprint."""
    return media_digest(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    return contamination_digest(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of documents on four-word shingles at 0.8."""
    return near_duplicates(documents(spark, sf_dir), width=4, percent=80)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed vocabulary files are; a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces in sequences of at most 2048 tokens."""
    return pack_documents(documents(spark, sf_dir), tokenizer_path(), length=2048)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat an earlier document."""
    return repeated_passages(documents(spark, sf_dir), min_words=50)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of every document."""
    return token_counts(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return predict_languages(documents(spark, sf_dir))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the standing rules on every page url."""
    return url_verdicts(table(spark, sf_dir, "pages"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every vector from the exact scatter."""
    return whitening(spread(table(spark, sf_dir, "embeddings")))


def op12_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern and random-string spans of every document."""
    return secret_digest(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.tiktoken"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact clusters of every vector by ball-tree rounds."""
    return cluster_digest(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_media_columns,
        op3_toxicity,
        op4_benchmark_decontamination,
        op5_minhash_near_dedup,
        op6_best_fit_packing,
        op7_substring_dedup,
        op8_token_counts,
        op9_language_id,
        op10_url_filters,
        op11_embedding_whitening,
        op12_secret_scans,
        op13_centroid_clustering,
    )
}

ORACLES: dict[str, str] = {
    "op4_benchmark_decontamination": CONTAMINATION_SQL,
    "op10_url_filters": URL_SQL,
    "op13_centroid_clustering": CLUSTER_SQL,
}
