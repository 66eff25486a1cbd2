"""Named queries over the driver tables, each with the SQL that DuckDB runs for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.runtime import table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where SQL can express it."""

    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size filter, first-wins dedup and count shards of ``documents``."""
    docs = table(spark, sf_dir, "documents").filter(F.col("n_chars").between(64, 8192))
    first = Window.partitionBy("h").orderBy("doc_id")
    kept = docs.withColumn("h", F.md5("text")).withColumn("rn", F.row_number().over(first)).filter("rn = 1")
    order = Window.partitionBy("source").orderBy("doc_id")
    return (
        kept.withColumn("shard", F.floor((F.row_number().over(order) - 1) / F.lit(10)))
        .groupBy(F.col("source").alias("dataset_id"), "shard")
        .agg(F.count("*").alias("samples"), F.sum("n_chars").alias("bytes"))
    )


from corpusloom.plans import catalog_archives, catalog_queries, catalog_records  # noqa: E402, F401  (registers the queries)
