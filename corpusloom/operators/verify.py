"""Integrity of content-addressed caches, and dataset summaries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import basename, dataset_name
from corpusloom.operators.resets import reset_sums
from corpusloom.runtime import ship
from corpusloom.sources.archives import OPENED, open_file, scheme_of, system_of


def is_hash(name: Column) -> Column:
    return name.rlike("^[0-9a-f]{64}$")


def blob_status(name: Column, digest: Column) -> Column:
    """valid, invalid, or skipped for files whose name is no digest; error where the content is unreadable."""
    return F.when(~F.coalesce(is_hash(name), F.lit(False)), "skipped").when(digest.isNull(), "error").when(name == digest, "valid").otherwise("invalid")


#: Bytes of blobs that one task reads, about, and of a piece that it reads at once.
TASK_BYTES, PIECE_BYTES = 4 << 30, 8 << 20


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path and size of the files in every folder ``blobs``, at any depth below the given ones."""
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            system, inner = system_of(folder)
            prefix = folder[: len(folder) - len(inner)] if folder.endswith(inner) else ""
            found = [i for i in system.get_file_info(fs.FileSelector(inner, recursive=True)) if i.type != fs.FileType.Directory and i.path.split("/")[-2] == "blobs"]
            columns = [pa.array([prefix + i.path for i in found], pa.string()), pa.array([i.size or 0 for i in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["path", "size"])


def stream_digest(path: str) -> str | None:
    """SHA-256 of a file of any size, read piece by piece; None where it cannot be read."""
    digest = hashlib.sha256()
    try:
        with open_file(path) as file:
            while piece := file.read(PIECE_BYTES):
                digest.update(piece)
    except OSError:
        return None
    return digest.hexdigest()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([stream_digest(path)], pa.string())], ["path", "digest"])


def cache_blobs(spark: SparkSession, cache_dir: str, dataset: str | None = None) -> DataFrame:
    """path, dataset, name and content digest of the blobs of a cache, null where one cannot be read.

    The driver lists the folders of datasets; tasks walk them, and read blobs in packs of about ``TASK_BYTES``.
    In stores that only Spark's readers know, blobs lie one folder deep and have less than 2 GB.
    """
    ship(spark)
    folder = "datasets--*" if dataset is None else "datasets--" + dataset.replace("/", "--")
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{cache_dir.rstrip('/')}/hub/{folder}")
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if scheme_of(cache_dir) in OPENED:
        folders = [(s.getPath().toString(),) for s in system.globStatus(top) or [] if s.isDirectory()]
        listed = spark.createDataFrame(folders, "path string").repartition(max(1, min(len(folders), 1000)), "path").mapInArrow(_walked, "path string, size long")
        packs = reset_sums(listed.withColumn("all", F.lit(0)), ["all"], ["path"], "size", TASK_BYTES, name="pack")
        n = (packs.agg(F.max("pack")).first()[0] or 0) + 1
        files = packs.repartition(n, "pack").select("path").mapInArrow(_digested, "path string, digest string")
    else:
        files = spark.read.format("binaryFile").load(f"{top.toString()}/blobs/*").select("path", F.sha2("content", 256).alias("digest"))
    return files.select("path", dataset_name(F.regexp_extract("path", r"/hub/([^/]+)/", 1)).alias("dataset"), basename(F.col("path")).alias("name"), "digest")


def verify_cache(blobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tally by status, and the rows that are invalid or unreadable."""
    judged = blobs.withColumn("status", blob_status(F.col("name"), F.col("digest")))
    return judged.groupBy("status").agg(F.count("*").alias("n")), judged.filter(F.col("status").isin("invalid", "error"))


def blobs_by_dataset(blobs: DataFrame) -> DataFrame:
    return blobs.groupBy("dataset").agg(F.count("*").alias("n"))


def describe_dataset(df: DataFrame, preview: int = 3, width: int = 100) -> dict[str, object]:
    """Rows, columns, types and a short preview of a dataset."""
    from corpusloom.functions.text import truncated

    shown = [truncated(F.col(f"`{c}`").cast("string"), width).alias(c) for c in df.columns]
    return {"rows": df.count(), "columns": df.columns, "types": dict(df.dtypes), "preview": [r.asDict() for r in df.select(*shown).limit(preview).collect()]}


def run_isolated(tasks: dict[str, object]) -> dict[str, str]:
    """Run each named callable; the names that failed with their errors."""
    failed: dict[str, str] = {}
    for name, task in tasks.items():
        try:
            task()
        except Exception as error:  # each task stands alone: its error is its result
            failed[name] = f"{type(error).__name__}: {error}"
    return failed


def failure_report(failed: dict[str, str]) -> str:
    return "".join(f"{name}: {error}\n" for name, error in sorted(failed.items()))
