"""Images in folders, arrays in npz files, Arrow IPC datasets, web records in tars."""

from __future__ import annotations

import zipfile
from collections.abc import Callable, Iterator
from typing import IO, Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.pixels import encode_png, loadable_size, to_rgb
from corpusloom.runtime import checkpoint, ship
from corpusloom.sources.archives import MOST_TASKS, OPENED, PLACE_COLUMNS, STRETCH, data_start, list_members, open_file, place, scheme_of, with_payload_arrays


def with_size(df: DataFrame, content: str = "content") -> DataFrame:
    """``width`` and ``height`` from the header of each image, null where it is none."""
    ship(df.sparkSession)

    @F.pandas_udf("width int, height int")
    def sized(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([loadable_size(c) or (None, None) for c in column], columns=["width", "height"]).astype("Int32")

    return df.withColumn("_size", sized(content)).withColumns({"width": F.col("_size.width"), "height": F.col("_size.height")}).drop("_size")


def in_file_order(rows: DataFrame, exact: bool = True) -> DataFrame:
    """``rows`` of a file source with ``_place``, which sorts by file name, then by the row's place in its file.

    ``exact`` sources number their rows (Parquet); of others a line's place is its block's and its order in it.
    """
    inside = [F.col("_metadata.row_index")] if exact else [F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
    return rows.select("*", F.struct(F.col("_metadata.file_path"), *inside).alias("_place"))


def read_images(spark: SparkSession, paths: list[str], extensions: tuple[str, ...]) -> DataFrame:
    """path, content, width, height of the image files below ``paths``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path", "content")
    return with_size(files.filter(F.lower("path").rlike(r"\.(" + "|".join(extensions) + ")$")))


#: Images of a batch of an npz file.
NPZ_ROWS = 256
_STRETCHES = "file string, split string, block int, archive string, path string, start long, stop long, at long, row_bytes long, shape array<long>, type string"


def _npy_header(file: IO[bytes]) -> tuple[tuple[int, ...], np.dtype]:
    """Shape and type of an array, whose first row is next in the file."""
    read = {(1, 0): np.lib.format.read_array_header_1_0, (2, 0): np.lib.format.read_array_header_2_0}[np.lib.format.read_magic(file)]
    shape, fortran, dtype = read(file)
    if fortran:
        raise ValueError("arrays in column order are not read")
    return shape, dtype


def _npz_stretches(batches: Iterator[pa.RecordBatch], names: list[str], splits: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Ranges of rows of the arrays, a few megabytes each where the array is stored; a deflated one whole, with a null ``at``."""
    types = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string()]
    for batch in batches:
        rows = []
        for archive, _, path, offset, _, method, _ in zip(*(batch.column(c).to_pylist() for c in PLACE_COLUMNS), strict=True):
            split, name = path.removesuffix("_images.npy"), archive.rsplit("/", 1)[-1]
            stored = method == zipfile.ZIP_STORED
            with open_file(archive) as file:
                if stored:
                    file.seek(data_start(file, offset))
                    shape, dtype = _npy_header(file)
                    at = file.tell()
                else:
                    with zipfile.ZipFile(file) as z, z.open(path) as member:
                        shape, dtype = _npy_header(member)
            row_bytes = dtype.itemsize * int(np.prod(shape[1:], dtype=np.int64))
            step = max(1, STRETCH // max(1, row_bytes)) if stored else max(1, shape[0])
            for start in range(0, shape[0], step):
                rows.append((name, split, names.index(name) * len(splits) + splits.index(split), archive, path, start, min(start + step, shape[0]), at if stored else None, row_bytes, list(shape[1:]), dtype.str))
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [c.split()[0] for c in _STRETCHES.split(", ")])


def _npz_images(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            with open_file(r["archive"]) as file:
                if r["at"] is None:
                    with zipfile.ZipFile(file) as z, z.open(r["path"]) as member:
                        _npy_header(member)
                        yield from _npz_rows(member, r)
                else:
                    file.seek(r["at"] + r["start"] * r["row_bytes"])
                    yield from _npz_rows(file, r)


def _npz_rows(file: IO[bytes], r: dict[str, Any]) -> Iterator[pa.RecordBatch]:
    """The images of a range, from a file that stands at its first."""
    types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int32()]
    for start in range(r["start"], r["stop"], NPZ_ROWS):
        n = min(NPZ_ROWS, r["stop"] - start)
        data = file.read(n * r["row_bytes"])
        images = np.frombuffer(data, np.dtype(r["type"])).reshape(n, *r["shape"])
        height, width = images.shape[1:3]
        columns = [[r["file"]] * n, [r["split"]] * n, [r["block"]] * n, list(range(start, start + n)), [encode_png(to_rgb(x)) for x in images], [width] * n, [height] * n]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["file", "split", "block", "ord", "content", "width", "height"])


def read_npz(spark: SparkSession, paths: list[str], splits: tuple[str, ...], ids: str = "id") -> DataFrame:
    """The images of npz files of any size as PNG: file, split, block (the place of file and split), ord, content, and their number.

    Arrays are read where they lie, a task for each stretch of rows of a stored one; a deflated array is
    streamed by one task.  The arrays' lengths give every image its number (``ids``), so images are not sorted.
    """
    names = [p.rstrip("/").rsplit("/", 1)[-1] for p in paths]
    wanted = {f"{s}_images.npy" for s in splits}
    entries = list_members(spark, paths, lambda p: p in wanted)
    if "content" in entries.columns:
        raise ValueError(f"tasks cannot open {paths[0]}")
    stretches = checkpoint(entries.mapInArrow(lambda batches: _npz_stretches(batches, names, splits), _STRETCHES))
    dealt = stretches.repartition(max(1, min(stretches.count(), MOST_TASKS)), "archive", "path", "start")
    images = dealt.mapInArrow(_npz_images, "file string, split string, block int, ord long, content binary, width int, height int")
    lengths = {r["block"]: r["n"] for r in stretches.groupBy("block").agg(F.max("stop").alias("n")).collect()}  # a few arrays
    ahead = [sum(n for b, n in lengths.items() if b < k) for k in range(len(paths) * len(splits))]
    return images.withColumn(ids, F.col("ord") + F.get(F.array(*(F.lit(a).cast("long") for a in ahead)), F.col("block")))


def read_web_records(spark: SparkSession, path: str, numbered: Callable[..., DataFrame] | None = None) -> DataFrame:
    """One row for each key of webdataset tars: archive, ord, key, jpg, json, width, height.

    Shards are ordered by name, which makes ordinals the same everywhere.  Keys are grouped, and given ids by
    ``numbered``, by the places of their members; payloads are read last.
    """
    members = list_members(spark, path, lambda p: p.lower().endswith((".jpg", ".jpeg", ".json")))
    extension = F.regexp_extract(F.lower("path"), r"\.([a-z]+)$", 1)
    rows = members.withColumns({"key": F.regexp_replace("path", r"\.[^./]*$", ""), "ext": F.when(extension == "json", "json").otherwise("jpg"), "place": place(members)})
    picked = lambda e: F.min_by(F.when(F.col("ext") == e, F.col("place")), F.when(F.col("ext") == e, F.col("ord")))
    keys = rows.groupBy("archive", "key").agg(F.min("ord").alias("ord"), F.array(picked("jpg"), picked("json")).alias("places"))
    keys = with_payload_arrays(keys if numbered is None else numbered(keys, "archive", "ord"), "places")
    jpg, text = F.get("payloads", F.lit(0)), F.get("payloads", F.lit(1))
    return keys.select(*(c for c in keys.columns if c not in ("places", "payloads")), jpg["content"].alias("jpg"), text["content"].cast("string").alias("json"), jpg["width"].alias("width"), jpg["height"].alias("height"))


def read_arrow_dataset(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of Arrow IPC stream files below ``path``, of any size, with ``_place`` by file name and row."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.arrow").option("recursiveFileLookup", "true").load(path)
    here = scheme_of(path) in OPENED
    files = files.select("path", *([] if here else ["content"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, name in enumerate(batch.column(0).to_pylist()):
                row = 0
                with open_file(name) if here else pa.BufferReader(batch.column(1)[k].as_buffer()) as file, pa.ipc.open_stream(file) as reader:
                    for part in reader:
                        places = pa.StructArray.from_arrays([pa.array([name] * len(part)), pa.array(range(row, row + len(part)), pa.int64())], ["file_path", "row_index"])
                        yield pa.RecordBatch.from_arrays([*part.columns, places], [*part.schema.names, "_place"])
                        row += len(part)

    return files.mapInArrow(run, schema + ", _place struct<file_path:string,row_index:bigint>")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table by its extension: Parquet, JSON lines, CSV with a header, or XLSX where pandas can read it."""
    if path.endswith((".json", ".jsonl")):
        return spark.read.json(path)
    if path.endswith(".csv"):
        return spark.read.csv(path, header=True)
    if path.endswith(".xlsx"):
        return spark.createDataFrame(pd.read_excel(path, dtype=str))
    return spark.read.parquet(path)


def materialised(spark: SparkSession, build: DataFrame, cache: str) -> DataFrame:
    """A lookup written once to ``cache`` and read from there ever after."""
    try:
        return spark.read.parquet(cache)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
    build.write.mode("overwrite").parquet(cache)
    return spark.read.parquet(cache)
