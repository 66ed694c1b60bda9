"""Connected components of an undirected graph, as joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import Scratch


def _is_star_forest(edges: DataFrame) -> bool:
    """True if every vertex is a leaf under one root or only a root."""
    seen = edges.select(F.col("hi").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select("lo", F.lit(0), F.lit(1))
    )
    bad = (
        seen.groupBy("v")
        .agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        .where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))
    )
    return bad.isEmpty()


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(v, root) for every vertex that has an edge; root is the component's least vertex.

    Alternates large-star and small-star steps (Kiveris et al., 2014), each of
    them one aggregate with map-side combining and one join, and writes the edge
    list after each round. Loops, repeated edges and both directions are fine;
    edges with a null end are ignored; no edges give no rows.
    """
    pair = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where(f"{a} is not null and {b} is not null")
    table = scratch.save(pair.where("hi > lo").distinct())
    while not _is_star_forest(table):
        # Large-star: every u gives its greater neighbours the least of its neighbours and itself.
        # Where that is u the edges stay as they are, so vertices of many edges mostly need no partner
        # here; the least are written, so the join is an outer one of two plain inputs that can be
        # broadcast when small and split when skewed.
        lower = scratch.save(table.groupBy("hi").agg(F.min("lo").alias("m")))
        up = table.select(F.col("lo").alias("u"), F.col("hi").alias("v")).join(lower.withColumnRenamed("hi", "u"), "u", "left")
        large = scratch.save(up.select(F.col("v").alias("hi"), F.coalesce("m", "u").alias("lo")).distinct())
        # Small-star: every u gives its lesser neighbours, and itself, the least of them.
        least = scratch.save(large.groupBy("hi").agg(F.min("lo").alias("m")))
        small = large.join(least, "hi", "left").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        small = small.unionAll(least.select("hi", F.col("m").alias("lo")))
        following = scratch.save(small.where("hi > lo").distinct())
        scratch.drop(table, lower, large, least)
        table = following
    return table.select(F.col("hi").alias("v"), F.col("lo").alias("root")).unionAll(
        table.select(F.col("lo").alias("v"), F.col("lo").alias("root")).distinct()
    )
