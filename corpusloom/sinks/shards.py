"""Sharded outputs: Arrow IPC streams by bytes, tars by count, Parquet.

Shards are laid out by light rows (order and bytes); a sample then finds its shard among the first keys of
shards, and its images are shuffled once, to the task that writes them.  The writing is a data source of its own,
``corpusloom_shards``: a task streams its sorted rows into files below a staging folder, batch by batch, and never
holds a shard; the job's commit lists the files of the tasks that succeeded, an abort deletes them.  A sink
returns the moves that bring staged files to their names, with the metadata beside them, for the run's one
commit record (``state.commits``); called as a function it makes them itself.
"""

from __future__ import annotations

import bisect
import io
import json
import os
import re
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from corpusloom.functions import text
from corpusloom.operators import folds
from corpusloom.operators.filters import GATED_TYPES
from corpusloom.operators.ordinals import dense_ids
from corpusloom.runtime import checkpoint, ship
from corpusloom.state.commits import Move, files_below, publish, read_text, remove


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    uri = re.sub(r"^file:/(?!/)", "file:///", folder) if ":" in folder else "file://" + os.path.abspath(folder)
    return pafs.FileSystem.from_uri(uri)


class SharedFile:
    """A file of a shared folder (a path or any URI that Arrow's file systems know), named when it is closed."""

    def __init__(self, folder: str, name: str):
        self.store, path = _store(folder)
        self.store.create_dir(path, recursive=True)
        self.final, self.part = f"{path}/{name}", f"{path}/.{name}.{uuid.uuid4().hex}"
        self.name, self.samples, self.bytes = name, 0, 0
        self.out = self.store.open_output_stream(self.part)

    def finish(self) -> None:
        self.out.close()
        self.store.move(self.part, self.final)


class _ArrowFile(SharedFile):
    """An Arrow stream of single-image samples."""

    def __init__(self, folder: str, name: str, include_caption: bool):
        super().__init__(folder, name)
        fields = [("dataset_id", pa.string()), ("sample_id", pa.int64()), ("image", pa.struct([("bytes", pa.binary()), ("path", pa.string())]))]
        self.schema = pa.schema(fields + [("caption", pa.string())] * include_caption)
        self.stream = pa.ipc.new_stream(self.out, self.schema)

    def write(self, rows: pa.RecordBatch) -> None:
        data = pc.struct_field(pc.list_element(rows.column("images"), 0), "bytes").cast(pa.binary())
        image = pa.StructArray.from_arrays([data, pa.nulls(len(data), pa.string())], fields=list(self.schema.field("image").type))
        columns = {"dataset_id": rows.column("dataset_id"), "sample_id": rows.column("sample_id"), "image": image, "caption": rows.column("caption")}
        self.stream.write_batch(pa.RecordBatch.from_arrays([columns[f.name] for f in self.schema], schema=self.schema))
        self.samples += rows.num_rows
        self.bytes += pc.sum(pc.binary_length(data)).as_py() or 0

    def finish(self) -> None:
        self.stream.close()
        super().finish()


class _TarFile(SharedFile):
    """A tar of images and texts."""

    def __init__(self, folder: str, name: str):
        super().__init__(folder, name)
        self.tar = tarfile.open(fileobj=self.out, mode="w|")  # noqa: SIM115  closed by finish

    def write(self, rows: pa.RecordBatch) -> None:
        for key, kind, images, body in zip(*(rows.column(c).to_pylist() for c in ("key", "sample_type", "images", "body")), strict=True):
            members = []
            for i, image in enumerate(images, 1):
                ext = file_extension(image["format"])
                members.append((f"{key}.img{i}.{ext}" if kind == "multi_image_text" else f"{key}.{ext}", image["bytes"]))
                self.bytes += len(image["bytes"])
            for name, data in [*members, (f"{key}.txt", body.encode("utf-8"))]:
                info = tarfile.TarInfo(name)
                info.size = len(data)
                self.tar.addfile(info, io.BytesIO(data))
        self.samples += rows.num_rows

    def finish(self) -> None:
        self.tar.close()
        super().finish()


def _opened(kind: str, folder: str, settings: dict[str, Any], key: tuple) -> SharedFile:
    """The staged file of a shard: of one dataset (Arrow), of all (tar), or an archive by its name."""
    from corpusloom.sinks import packing

    if kind == "arrow":
        dataset, shard = key
        return _ArrowFile(f"{folder}/{dataset}", f"data-{settings['start'].get(dataset, 0) + shard:05d}.arrow", settings["include_caption"])
    if kind == "packed":
        return packing.PACKERS[packing.ending(key[0])](folder, key[0])
    return _TarFile(folder, f"part-{settings['start'] + key[0]:06d}.tar")


@dataclass
class _Written(WriterCommitMessage):
    """The files of one task: dataset ("" where a file holds several), name, samples, bytes."""

    files: list[tuple[str, str, int, int]]


class ShardSink(DataSource):
    """``df.write.format("corpusloom_shards")``: files of rows that come sorted by their keys, below a staging folder."""

    @classmethod
    def name(cls) -> str:
        return "corpusloom_shards"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _ShardWriter(dict(self.options))


FILE_LIST = "_files.json"


class _ShardWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.kind, self.folder = options["kind"], options["path"]
        self.settings, self.keys = json.loads(options["settings"]), json.loads(options["keys"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        key, file, files = None, None, []

        def finish() -> None:
            file.finish()
            files.append((key[0] if len(key) > 1 else "", file.name, file.samples, file.bytes))

        for batch in iterator:
            found = list(zip(*(batch.column(k).to_pylist() for k in self.keys), strict=True))
            starts = [k for k in range(len(found)) if k == 0 or found[k] != found[k - 1]]
            for start, end in zip(starts, [*starts[1:], len(found)], strict=True):
                if found[start] != key:
                    if file is not None:
                        finish()
                    key, file = found[start], _opened(self.kind, self.folder, self.settings, found[start])
                file.write(batch.slice(start, end - start))
        if file is not None:
            finish()
        return _Written(files)

    def commit(self, messages: list[_Written | None]) -> None:
        store, path = _store(self.folder)
        store.create_dir(path, recursive=True)
        files = sorted(f for m in messages if m is not None for f in m.files)
        with store.open_output_stream(f"{path}/{FILE_LIST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[_Written | None]) -> None:
        store, path = _store(self.folder)
        for dataset, name, *_ in (f for m in messages if m is not None for f in m.files):
            file = f"{path}/{dataset}/{name}" if dataset else f"{path}/{name}"
            if store.get_file_info(file).type == pafs.FileType.File:
                store.delete_file(file)


def written(rows: DataFrame, keys: list[str], order: list[str], kind: str, staging: str, settings: dict[str, Any]) -> list[list]:
    """Write the rows of each key to its file, in order; the list of files."""
    spark = rows.sparkSession
    spark.dataSource.register(ShardSink)
    options = {"kind": kind, "settings": json.dumps(settings), "keys": json.dumps(keys)}
    rows.repartition(*keys).sortWithinPartitions(*keys, *order).write.format("corpusloom_shards").mode("append").options(**options).save(staging)
    return json.loads(read_text(spark, f"{staging}/{FILE_LIST}") or "[]")


def _placed(rows: DataFrame, keys: list[str], starts: list[tuple], name: str = "shard") -> DataFrame:
    """``rows`` with the number of the last of ``starts`` (values of ``keys`` and a number, sorted) that is not beyond its keys.

    There is one start for each file that the job writes.
    """
    firsts, numbers = [_sortable(s[:-1]) for s in starts], [s[-1] for s in starts]
    at = [rows.columns.index(k) for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [numbers[max(0, bisect.bisect_right(firsts, _sortable(k)) - 1)] for k in zip(*(batch.column(c).to_pylist() for c in at), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], [*batch.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())]))


def _sortable(key: tuple) -> tuple:
    return tuple((v is not None, v) if v is not None else (False,) for v in key)


def file_extension(form: str | None) -> str:
    """The extension of an image format; PNG where it is unknown."""
    return {"": "png", "jpeg": "jpg"}.get((form or "").lower(), (form or "").lower())


ORDER = ["adapter_pos", "src_ord"]


def arrow_layout(samples: DataFrame, target_shard_bytes: int, batch_size: int = 1000) -> list[tuple]:
    """The first (dataset, adapter_pos, src_ord) of each Arrow shard with its number, in order.

    A shard ends with the chunk (the accepted part of a batch, split at 1.5e9 bytes) that brings it
    to the target.
    """
    light = samples.select("dataset_id", *ORDER, F.coalesce(F.length(F.get("images", F.lit(0))["bytes"]), F.lit(0)).cast("long").alias("_bytes"))
    light = dense_ids(light, ["dataset_id"], ORDER, "_ord").withColumn("_batch", F.floor(F.col("_ord") / batch_size).cast("long"))

    chunks = folds.capped_chunks(light, ["dataset_id", "_batch"], "_ord", "_bytes", name="_chunk")
    totals = chunks.groupBy("dataset_id", "_batch", "_chunk").agg(F.sum("_bytes").alias("_size"), F.min(F.struct("_ord", *ORDER)).alias("_first"))
    totals = checkpoint(totals.withColumn("_seq", F.col("_batch") * 1_000_000 + F.col("_chunk")))
    shards = folds.byte_shards(totals, "dataset_id", "_seq", "_size", target_shard_bytes)
    firsts = shards.groupBy("dataset_id", "shard").agg(F.min("_first").alias("f")).select("dataset_id", *(f"f.{c}" for c in ORDER), "shard")
    return sorted(map(tuple, firsts.collect()))


def arrow_files(samples: DataFrame, staging: str, target_shard_bytes: int, batch_size: int = 1000, include_caption: bool = False, first_index: dict[str, int] | None = None) -> list[list]:
    """Write Arrow stream files of the single-image samples below ``staging``; dataset, name, samples and bytes of each."""
    ship(samples.sparkSession)
    rows = samples.filter(F.col("sample_type").isin(*GATED_TYPES))
    rows = rows.select("dataset_id", *ORDER, "sample_id", "images", F.coalesce("text", F.lit("")).alias("caption"))
    placed = _placed(rows, ["dataset_id", *ORDER], arrow_layout(rows, target_shard_bytes, batch_size))
    settings = {"start": first_index or {}, "include_caption": include_caption}
    return written(placed, ["dataset_id", "shard"], ORDER, "arrow", staging, settings)


def tar_files(samples: DataFrame, staging: str, maxcount: int = 10_000, first_index: int = 0) -> list[list]:
    """Write tar files of all samples with images below ``staging``.  Text samples are left out.

    Members are ``{key}.{ext}`` or ``{key}.img{i}.{ext}``, and ``{key}.txt`` with a token for each image.
    """
    ship(samples.sparkSession)
    order = ["adapter_pos", "dataset_id", "src_ord"]
    rows = samples.filter("sample_type != 'text'")
    light = dense_ids(rows.select(*order).withColumn("_all", F.lit(0)), ["_all"], order, "_ord")
    starts = sorted(map(tuple, light.filter(F.col("_ord") % maxcount == 0).select(*order, F.floor(F.col("_ord") / maxcount).alias("shard")).collect()), key=lambda s: s[-1])
    body = F.coalesce("text", F.lit(""))
    body = F.when(F.col("sample_type") == "multi_image_text", text.ensure_tokens(body, F.size("images"))).otherwise(body)
    rows = rows.select(*order, "sample_type", "images", body.alias("body"), text.record_key(F.col("dataset_id"), F.col("sample_id")).alias("key"))
    return written(_placed(rows, order, starts), ["shard"], order, "tar", staging, {"start": first_index})


@dataclass
class Staged:
    """What a sink has made and not yet shown: moves of files to their places, and metadata to put there after."""

    moves: list[Move]
    puts: dict[str, str]


class Sink(Protocol):
    """Places samples below ``output_dir`` by way of a staging folder; further options are its configuration's."""

    def stage(self, samples: DataFrame, output_dir: str, staging: str, **options: Any) -> Staged: ...


class _Sink:
    def __call__(self, samples: DataFrame, output_dir: str, **options: Any) -> None:
        """Stage and publish, for use outside a run."""
        staging = f"{output_dir}/{STAGING}{uuid.uuid4().hex}"
        staged = self.stage(samples, output_dir, staging, **options)
        publish(samples.sparkSession, staged.moves, staged.puts)
        remove(samples.sparkSession, staging)


#: Folders that begin with this hold what is not committed.
STAGING = ".staging-"


class ArrowSink(_Sink):
    """Arrow shards below ``output_dir/<dataset>`` with loader metadata and running totals."""

    def stage(self, samples: DataFrame, output_dir: str, staging: str, *, target_shard_bytes: int, include_caption: bool = False, batch_size: int = 1000, **_: Any) -> Staged:
        spark = samples.sparkSession
        names = [r[0] for r in samples.select("dataset_id").distinct().collect()]
        old = {d: _stats(spark, f"{output_dir}/{d}") for d in names}
        files = arrow_files(samples, staging, target_shard_bytes, batch_size, include_caption, {d: t.get("files", 0) for d, t in old.items()})
        staged = Staged([[f"{staging}/{d}/{n}", f"{output_dir}/{d}/{n}"] for d, n, _, _ in files], {})
        for dataset in names:
            own = [f for f in files if f[0] == dataset]
            if own:
                total = {k: old[dataset].get(k, 0) + v for k, v in (("total_bytes", sum(f[3] for f in own)), ("total_samples", sum(f[2] for f in own)), ("files", len(own)))}
                shown = loader_metadata([f"data-{k:05d}.arrow" for k in range(total["files"])], total, include_caption)
                staged.puts |= {f"{output_dir}/{dataset}/{n}": json.dumps(c, indent=2) for n, c in shown.items()}
                staged.puts[f"{output_dir}/{dataset}/.stats.json"] = json.dumps(total)
        return staged


class TarSink(_Sink):
    """Tar shards in ``output_dir`` with running totals by dataset."""

    def stage(self, samples: DataFrame, output_dir: str, staging: str, *, maxcount: int = 10_000, **_: Any) -> Staged:
        spark = samples.sparkSession
        old = _stats(spark, output_dir)
        files = tar_files(samples, staging, maxcount, old.get("files", 0))
        counts = {r["dataset_id"]: r["n"] for r in samples.filter("sample_type != 'text'").groupBy("dataset_id").agg(F.count("*").alias("n")).collect()}
        datasets = dict(old.get("dataset_samples", {}))
        for name, n in counts.items():
            datasets[name] = datasets.get(name, 0) + n
        total = {"total_samples": sum(datasets.values()), "dataset_samples": datasets, "files": old.get("files", 0) + len(files)}
        return Staged([[f"{staging}/{n}", f"{output_dir}/{n}"] for _, n, _, _ in files], {f"{output_dir}/.stats.json": json.dumps(total)})


class ParquetSink(_Sink):
    """Parquet files in a folder for each dataset."""

    def stage(self, samples: DataFrame, output_dir: str, staging: str, **_: Any) -> Staged:
        samples.write.partitionBy("dataset_id").parquet(staging)
        return Staged([[f"{staging}/{f}", f"{output_dir}/{f}"] for f in files_below(samples.sparkSession, staging, ".parquet")], {})


def loader_metadata(files: list[str], total: dict[str, int], include_caption: bool) -> dict[str, object]:
    """The two JSON files that dataset loaders look for."""
    features: dict[str, object] = {
        "dataset_id": {"dtype": "string", "_type": "Value"},
        "sample_id": {"dtype": "int64", "_type": "Value"},
        "image": {"_type": "Image"},
    }
    if include_caption:
        features["caption"] = {"dtype": "string", "_type": "Value"}
    split = {"name": "train", "num_bytes": total["total_bytes"], "num_examples": total["total_samples"]}
    state = {"_data_files": [{"filename": f} for f in sorted(files)], "_fingerprint": "corpusloom", "_format_type": None, "_split": "train"}
    return {"state.json": state, "dataset_info.json": {"features": features, "splits": {"train": split}}}


def _stats(spark: SparkSession, folder: str) -> dict:
    return json.loads(read_text(spark, f"{folder}/.stats.json") or "{}")


write_arrow, write_tars, write_parquet = ArrowSink(), TarSink(), ParquetSink()
WRITERS: dict[str, Sink] = {"huggingface": write_arrow, "webdataset": write_tars, "parquet": write_parquet}


def register(name: str, writer: Sink) -> None:
    """Make a sink known to configurations under ``name``."""
    WRITERS[name] = writer
