"""First-wins dedup, incremental dedup against a hash store, distinct inserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: Column, *order: str | Column, applies: Column | None = None) -> DataFrame:
    """The first row of each key in ``order``; rows outside ``applies``, or with a null key, pass.

    Spark prunes to one row a key before the shuffle (window group limit), so hot keys stay small.
    """
    keyed = df.withColumn("_key", key if applies is None else F.when(applies, key))
    first = keyed.filter("_key IS NOT NULL").withColumn("_rn", F.row_number().over(Window.partitionBy("_key").orderBy(*order))).filter("_rn = 1").drop("_rn")
    return first.unionByName(keyed.filter("_key IS NULL")).drop("_key")


def against_store(df: DataFrame, store: DataFrame, key: str, owner: list[str]) -> DataFrame:
    """Rows whose key the store lacks or holds for the same owner, so a replay passes.

    ``store`` has one row for each key, with the owner's columns.
    """
    known = store.select(F.col(key), *(F.col(c).alias(f"_own_{c}") for c in owner))
    joined = df.join(known, key, "left")
    mine = F.lit(True)
    for c in owner:
        mine = mine & F.col(f"_own_{c}").eqNullSafe(F.col(c))
    unknown = F.lit(True)
    for c in owner:
        unknown = unknown & F.col(f"_own_{c}").isNull()
    return joined.filter(unknown | mine).drop(*(f"_own_{c}" for c in owner))


def insert_distinct(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows to append to ``table``: distinct by ``keys`` and not in it."""
    return rows.dropDuplicates(keys).join(table.select(*keys).distinct(), keys, "left_anti")


def last_wins(df: DataFrame, key: str, order: str, *values: str) -> DataFrame:
    """For each key the values of its last row in ``order``."""
    return df.groupBy(key).agg(*(F.max_by(v, order).alias(v) for v in values))
