"""Vector queries: similarity top-k, content retrieval, listings."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    pairs = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where either vector has no length."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(F.lit(0.0))


def top_k(vectors: DataFrame, query: list[float], k: int, key: str = "id") -> DataFrame:
    """The k nearest vectors to one query; a top-k per partition, then one of those."""
    q = F.array(*(F.lit(float(x)) for x in query))
    return vectors.select(key, cosine(F.col("embedding"), q).alias("score")).orderBy(F.desc("score"), key).limit(k)


def retrieve(vectors: DataFrame, content: DataFrame, query: list[float], k: int, key: str = "id", content_key: str = "content_hash") -> DataFrame:
    """Top-k with their content."""
    hits = top_k(vectors, query, k, key)
    return hits.join(content.withColumnRenamed(content_key, key), key)


def list_ids(vectors: DataFrame, key: str = "id") -> DataFrame:
    """All ids of a store that can list."""
    return vectors.select(key)


def list_ids_by_query(vectors: DataFrame, most: int, key: str = "id") -> DataFrame:
    """Ids of a store that can only search: a query with the zero vector gives `most` at a time, with a warning if there may be more."""
    found = vectors.select(key).orderBy(key).limit(most)
    if found.count() == most:
        warnings.warn(f"the listing stops at {most} ids; there may be more", stacklevel=2)
    return found
