"""Global ranks and first/last rows without a single-partition window."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..scratch import settled
from ..shipping import ship


def with_rank(rows: DataFrame, *order: str) -> DataFrame:
    """Add rank (from 0) by order columns, of any orderable kind: local numbers plus the counts of earlier ranges.

    Rows are dealt by range over all order columns, as sampled bounds have it, and
    settled, so that a row's range is the same in both uses of the plan. Rows that
    agree in all order columns share a range.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settled(rows.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id()))
    counts = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    local = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1
    out = ranged.withColumn("__local", local).join(F.broadcast(base), "__range")  # one row a range
    return out.withColumn("rank", F.col("__base") + F.col("__local")).drop("__range", "__local", "__base")


def keep_first(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key; an aggregate, so copies combine before the shuffle."""
    columns = [F.col(c) for c in rows.columns]
    best = rows.groupBy(F.col(key).alias("__key")).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("__row"))
    return best.select("__row.*")


def keep_last(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key; an aggregate, so copies combine before the shuffle."""
    columns = [F.col(c) for c in rows.columns]
    best = rows.groupBy(F.col(key).alias("__key")).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("__row"))
    return best.select("__row.*")


def greedy_packs(rows: DataFrame, key: str, order: str, size: str, limit: int) -> DataFrame:
    """(key, order, size, pack): the rows of each key in order, a new pack where the next one would pass the limit.

    Each row decides about the next, so a key is read in one go; its rows stream
    through in sorted batches, and only the running sum is held.
    """
    ship(rows.sparkSession)
    dealt = rows.select(key, order, F.col(size).cast("long").alias(size)).repartition(key).sortWithinPartitions(key, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, filled, pack = object(), 0, 0
        for batch in batches:
            packs = []
            for k, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != last:
                    last, filled, pack = k, n or 0, 0
                elif filled + (n or 0) > limit:
                    filled, pack = n or 0, pack + 1
                else:
                    filled += n or 0
                packs.append(pack)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(packs, pa.int64())], names=[key, order, size, "pack"])

    fields = [*dealt.schema.fields, StructField("pack", LongType())]
    return dealt.mapInArrow(run, StructType(fields))
