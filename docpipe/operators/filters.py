"""Gates, labels and violations of chunk rows; expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T

REQUIRED = ("content", "doc_path", "section", "section_path", "page_context", "content_hash", "url", "metadata")


def should_embed(tokens: Column, path: Column) -> Column:
    """Bound once in a lambda: a filter would compute a token count for each place where it is named."""
    return F.exists(F.array(tokens), lambda n: (n >= C.EMBED_MIN) & ((n <= C.EMBED_MAX) | T.is_forced(path)))


def embed_label(tokens: Column, path: Column) -> Column:
    """too_small, too_large or embeddable; each row has one."""
    return F.when(tokens < C.EMBED_MIN, "too_small").when((tokens > C.EMBED_MAX) & ~T.is_forced(path), "too_large").otherwise("embeddable")


def is_oversized(tokens: Column) -> Column:
    return tokens > C.OVERSIZED


def near_minimum(tokens: Column) -> Column:
    return tokens.between(C.EMBED_MIN, C.NEAR_MIN)


def embed_stats(chunks: DataFrame, tokens: str = "token_count", path: str = "doc_path") -> DataFrame:
    """Counts and percentages of the labels, as one row; percentages of no rows are null."""
    t, p = F.col(tokens), F.col(path)
    label = embed_label(t, p)
    counts = chunks.agg(
        F.count("*").alias("total"),
        *(F.count_if(label == k).alias(k) for k in ("embeddable", "too_small", "too_large")),
        F.count_if(is_oversized(t)).alias("oversized"),
    )
    share = lambda k: F.round(100.0 * F.col(k) / F.nullif(F.col("total"), F.lit(0)), 1).alias(f"{k}_pct")
    return counts.select("*", *(share(k) for k in ("embeddable", "too_small", "too_large", "oversized")))


def valid_for_embedding() -> Column:
    """Content with a visible character, a hash, a path array and a context; an empty array counts as present."""
    return (
        (T.trim_ws(F.coalesce(F.col("content"), F.lit(""))) != "")
        & (F.coalesce(F.col("content_hash"), F.lit("")) != "")
        & F.col("section_path").isNotNull()
        & (F.coalesce(F.col("page_context"), F.lit("")) != "")
    )


def violations(chunks: DataFrame, columns: tuple[str, ...] = REQUIRED) -> DataFrame:
    """(chunk columns..., field): one row for each required field that is null."""
    missing = F.filter(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in columns)), lambda x: x.isNotNull())
    return chunks.withColumn("field", F.explode(missing))


def invalid_chunk() -> Column:
    """A chunk that makes its file fail: blank content or a hash that is not 64 signs."""
    blank = T.trim_ws(F.coalesce(F.col("content"), F.lit(""))) == ""
    return blank | F.coalesce(F.length("content_hash") != 64, F.lit(True))


def drop_bad_files(chunks: DataFrame, bad: Column, path: str = "doc_path") -> tuple[DataFrame, DataFrame]:
    """(chunks of files without a bad chunk, the paths of the others)."""
    failed = chunks.where(bad).select(path).distinct()
    return chunks.join(failed, path, "left_anti"), failed


def bad_hash(c: Column) -> Column:
    return ~F.coalesce(c.rlike("^[a-f0-9]{64}$"), F.lit(False))


def systematic_sample(rows: DataFrame, order: str, most: int = 50) -> DataFrame:
    """Every step-th row by order, at most `most`; the step is the count over the sample size, rounded down.

    Rank is found by range partitioning: rows are numbered inside partitions and
    offset by the counts of those before, so no single task sorts all rows.
    """
    from .ranking import with_rank

    n = rows.count()
    step = max(1, n // max(1, min(most, n)))
    ranked = with_rank(rows, order)
    return ranked.where((F.col("rank") % step == 0) & (F.col("rank") < step * most)).drop("rank")


def count_ratio(expected: DataFrame, stored: DataFrame, least: float = 0.9) -> DataFrame:
    """One row: expected (as it is and without repeats), stored, and whether stored is at least the share of expected."""
    e = expected.agg(F.count("*").alias("expected"), F.countDistinct("content_hash").alias("expected_distinct"))
    return e.crossJoin(stored.agg(F.count("*").alias("stored"))).withColumn("enough", F.col("stored") >= least * F.col("expected"))
