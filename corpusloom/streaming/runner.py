"""Micro-batch runs: idempotent sinks, dedup state, resumption."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from corpusloom.runtime import scratch_folder
from corpusloom.sources.archive_stream import BATCH
from corpusloom.sources.archives import register


def run_folder(spark: SparkSession) -> str:
    return scratch_folder(spark, "stream")


def drain(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run a stream over all data there is, batch by batch, through ``write(batch, id)``.

    The checkpoint makes a restart repeat at most the last batch under its old id, so a sink that
    overwrites by id sees each row once.
    """
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def drain_by_steps(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """As ``drain``, for a source that sets the size of its batches itself (``availableNow`` would take one of them only)."""
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def archive_stream(spark: SparkSession, path: str, log: str, batch_bytes: int = BATCH, **options: str) -> DataFrame:
    """A stream over the members of the archives that arrive at ``path`` (a glob), about ``batch_bytes`` of archives a batch.

    ``log`` is a folder of this stream alone; ``options`` are ``suffixes``, ``prefix`` and ``nested``.
    """
    register(spark)
    return spark.readStream.format("archive").options(**options, log=log, maxBytesPerTrigger=batch_bytes).load(path)


def overwrite_by_batch(folder: str) -> Callable[[DataFrame, int], None]:
    """A Parquet sink with one folder for each batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return write


def file_stream(spark: SparkSession, path: str, files_per_batch: int = 64) -> DataFrame:
    """A stream over the Parquet files of a table, whether one file or a folder."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path + "*")


def distinct_stream(spark: SparkSession, path: str, key: Column) -> DataFrame:
    """The keys (``h``) that pass a streaming dedup over a table's files."""
    folder = run_folder(spark)
    kept = file_stream(spark, path).select(key.alias("h")).dropDuplicates(["h"])
    drain(kept, overwrite_by_batch(f"{folder}/out"), f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").select("h")
