"""Dense ordinals, batches, shards, skips and takes over an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.runtime import checkpoint


def dense_ids(df: DataFrame, group: list[str], order: list[str], name: str = "sample_id") -> DataFrame:
    """Ordinals from 0 within ``group`` along ``order``, without gathering a group in one task.

    Rows are dealt by ranges of group and order; an ordinal is the number of the group's rows in
    earlier ranges plus the rank inside its own range.
    """
    parts = checkpoint(df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()))
    counts = parts.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.withColumn("_ahead", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order))
    numbered = parts.withColumn("_rank", inside).alias("r")
    same = F.col("r._part") == F.col("a._part")
    for g in group:
        same = same & F.col(f"r.{g}").eqNullSafe(F.col(f"a.{g}"))
    out = numbered.join(ahead.alias("a"), same).withColumn(name, (F.col("_ahead") + F.col("_rank") - 1).cast("long"))
    return out.select(*(F.col(f"r.{c}") for c in df.columns if c != name), name)


def batch_of(ordinal: Column, size: int) -> Column:
    return F.floor(ordinal / F.lit(size)).cast("long")


def sub_batch_size(n: int, workers: int) -> int:
    """Rows of a batch handed to each worker; there may be more pieces than workers."""
    return max(1, n // workers)


def chunk_size(n: int, pieces: int) -> int:
    """Rows of each of ``pieces`` equal chunks, the last one short."""
    return -(-n // pieces) if n else 0


def chunk_range(total: int, pieces: int, k: int) -> tuple[int, int]:
    """First row and end of the k-th of ``pieces`` contiguous ranges, the end clamped."""
    size = chunk_size(total, pieces)
    return min(k * size, total), min((k + 1) * size, total)


def skip_take(df: DataFrame, order: list[str], skip: int = 0, take: int | None = None) -> DataFrame:
    out = df.orderBy(*order).offset(skip)
    return out if take is None else out.limit(take)
