"""State that outlives a run: manifest, progress, hash owners; Parquet in folders by run.

Readers look at folders ``run=*`` only.  ``add`` and ``update`` show their rows at once; with ``staged`` they leave
them in a pending folder and return the move that shows them, for a commit record.  ``compact`` folds the folders into
one, which names those it replaces: readers pass these over from the moment it is shown, whether they are
deleted yet or not.  The hash store lies in buckets by hash, and an addition reads those alone that it touches.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators.dedup import insert_distinct
from corpusloom.state.commits import Move, move, names_in, put, read_text, remove

#: Folders of a table that are folded into one when a run begins, and the file that names those replaced.
MOST_RUNS, REPLACES = 16, "_replaces"


class _Table:
    schema = ""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _runs(self) -> tuple[list[str], set[str]]:
        """The folders that count, and those that another has replaced."""
        names = [n for n in names_in(self.spark, self.path) if n.startswith("run=")]
        replaced = {old for n in names for old in json.loads(read_text(self.spark, f"{self.path}/{n}/{REPLACES}") or "[]")}
        return [n for n in names if n not in replaced], replaced & set(names)

    def read(self) -> DataFrame:
        runs, _ = self._runs()
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(f"{self.schema}, run string").option("basePath", self.path)
        return rows.parquet(*(f"{self.path}/{n}" for n in runs)).drop("run")

    def compact(self, most: int = MOST_RUNS) -> None:
        """Fold the table's folders into one where there are more than ``most``; not while an addition is staged."""
        runs, _ = self._runs()
        if len(runs) > most:
            name = uuid.uuid4().hex
            pending = f"{self.path}/.pending-{name}"
            self._written(self.read(), pending)
            put(self.spark, f"{pending}/{REPLACES}", json.dumps(runs))
            move(self.spark, pending, f"{self.path}/run={name}")
        for old in self._runs()[1]:
            remove(self.spark, f"{self.path}/{old}")

    def _written(self, rows: DataFrame, path: str) -> None:
        rows.write.parquet(path)

    def append(self, rows: DataFrame, staged: bool = False) -> Move:
        """Add rows as one folder."""
        name = uuid.uuid4().hex
        made = [f"{self.path}/.pending-{name}", f"{self.path}/run={name}"]
        self._written(rows, made[0])
        if not staged:
            move(self.spark, *made)
        return made

    def sweep(self) -> None:
        """Delete what runs that died have left pending."""
        for name in names_in(self.spark, self.path):
            if name.startswith(".pending-"):
                remove(self.spark, f"{self.path}/{name}")


class Manifest(_Table):
    """The samples that passed, each pair of dataset and sample once."""

    schema = "dataset_id string, sample_id long"

    def add(self, samples: DataFrame, staged: bool = False) -> Move:
        return self.append(insert_distinct(self.read(), samples.select("dataset_id", "sample_id"), ["dataset_id", "sample_id"]), staged)

    def exists(self, dataset_id: str, sample_id: int) -> bool:
        return not self.read().filter((F.col("dataset_id") == dataset_id) & (F.col("sample_id") == sample_id)).isEmpty()

    def counts(self) -> DataFrame:
        return self.read().groupBy("dataset_id").agg(F.count("*").alias("n"))

    def dataset(self, dataset_id: str) -> DataFrame:
        return self.read().filter(F.col("dataset_id") == dataset_id).orderBy("sample_id")


class Progress(_Table):
    """The last sample and completion of each dataset; the newest entry counts."""

    schema = "dataset_id string, last_sample_id long, completed boolean, version long"

    def current(self) -> DataFrame:
        newest = Window.partitionBy("dataset_id").orderBy(F.col("version").desc())
        return self.read().withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")

    def get(self, dataset_id: str) -> tuple[int | None, bool]:
        row = self.current().filter(F.col("dataset_id") == dataset_id).first()
        return (row["last_sample_id"], row["completed"]) if row else (None, False)

    def update(self, dataset_id: str, last_sample_id: int | None, completed: bool = False, staged: bool = False) -> Move:
        version = (self.read().agg(F.max("version")).first()[0] or 0) + 1
        return self.append(self.spark.createDataFrame([(dataset_id, last_sample_id, completed, version)], self.schema).coalesce(1), staged)

    def record(self, rows: DataFrame) -> Move:
        """Entries (dataset_id, last_sample_id, completed) of many datasets at once, newer than all before."""
        version = (self.read().agg(F.max("version")).first()[0] or 0) + 1
        return self.append(rows.select("dataset_id", "last_sample_id", "completed", F.lit(version).cast("long").alias("version")))

    def completed(self) -> DataFrame:
        return self.current().filter("completed").select("dataset_id")


class HashStore(_Table):
    """The owner of each perceptual hash, in 256 buckets by hash."""

    schema = "img_hash string, dataset_id string, sample_id long, bucket string"

    def add(self, owners: DataFrame, staged: bool = False) -> Move:
        rows = owners.select("img_hash", "dataset_id", "sample_id", F.substring(F.md5("img_hash"), 1, 2).alias("bucket"))
        touched = [r[0] for r in rows.select("bucket").distinct().collect()]
        return self.append(insert_distinct(self.read().filter(F.col("bucket").isin(touched)), rows, ["img_hash"]), staged)

    def _written(self, rows: DataFrame, path: str) -> None:
        rows.repartition("bucket").write.partitionBy("bucket").parquet(path)


class Downloads(_Table):
    """What each run of a download got of its addresses."""

    schema = "url string, name string, bytes long, etag string, tries int, status string, error string"
