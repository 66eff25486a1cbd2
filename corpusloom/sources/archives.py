"""Archive members as rows: zip, tar, gzipped and zstandard tars, zips inside zips.

Spark's ``binaryFile`` reader lists the archives, so they may lie in any store it reads; tasks open them
where they lie and read what they need, so an archive may have any size.  A scan has two phases: ``list_members``
gives the place of each wanted member without its payload, and ``with_payloads`` reads payloads.  What lies
between them (predicates, lookups, ids) moves rows of a few bytes, and a payload is read once, by the task that
passes it on.  Members of zips, plain tars and stored inner zips are read at their place, in many tasks, each a
stretch of the file.  Compressed tars are listed by streaming them once; a payload is then read from the start of the
frame (of zstandard) or member (of gzip) that holds its first byte, so an archive of many frames is read by many
tasks and one of a single frame by one.  Members of compressed inner zips go by way of the task's disk.  One member
must fit in a value of 2 GB.

Stores that only Spark's readers know are read through ``binaryFile`` content, archives below 2 GB.
"""

from __future__ import annotations

import csv
import fnmatch
import glob
import io
import os
import re
import tarfile
import tempfile
import warnings
import zipfile
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from typing import IO, Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.functions.pixels import loadable_size
from corpusloom.runtime import ship

MEMBERS = "archive string, ord long, path string, content binary, width int, height int"
PLACES = "archive string, ord long, path string, offset long, size long, method int, skip long"
PLACE_COLUMNS = [c.split()[0] for c in PLACES.split(", ")]
_PAYLOAD = T.StructType([T.StructField("content", T.BinaryType()), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())])
#: Schemes that tasks can open by themselves; others go through Spark's reader.
OPENED = ("file", "hdfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")
#: Names of zips.
ZIPS = (".zip", ".npz")
#: Bytes of a zip that one task reads in a row, and bytes and rows of a batch of members.
STRETCH, BATCH_BYTES, BATCH_ROWS = 64 << 20, 32 << 20, 64
#: Tasks that read payloads, at most (a task then reads several stretches), and listed rows of a batch.
MOST_TASKS, LISTED_ROWS = 100_000, 10_000
Want = Callable[[str], bool]


def everything(path: str) -> bool:
    return True


def _errors() -> tuple[type[Exception], ...]:
    """What a damaged archive raises."""
    import zstandard

    return zipfile.BadZipFile, tarfile.TarError, EOFError, OSError, zlib.error, zstandard.ZstdError, NotImplementedError


def scheme_of(path: str) -> str:
    head, colon, _ = path.partition(":")
    return head if colon and "/" not in head else "file"


def system_of(path: str) -> tuple[fs.FileSystem, str]:
    """The local system or a store that Arrow reads, and the path in it."""
    scheme = scheme_of(path)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path
    return fs.FileSystem.from_uri("s3" + path.removeprefix("s3a") if scheme == "s3a" else path)


def open_file(path: str) -> IO[bytes]:
    """A seekable file of the local system or of a store that Arrow reads."""
    system, inner = system_of(path)
    file = system.open_input_file(inner)
    return io.BufferedReader(_Stretch(file, 0, file.size()), 1 << 20)


class _Stretch(io.RawIOBase):
    """A part of a file as a file."""

    def __init__(self, file: IO[bytes], start: int, size: int):
        self.file, self.start, self.size, self.at = file, start, size, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        at = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.at, io.SEEK_END: self.size}[whence]
        if at < 0:
            raise OSError("before the start of the file")
        self.at = at
        return at

    def readinto(self, buffer: Any) -> int:
        self.file.seek(self.start + self.at)
        data = self.file.read(max(0, min(len(buffer), self.size - self.at)))
        buffer[: len(data)] = data
        self.at += len(data)
        return len(data)


#: Where the outermost entries of a zip begin that a walk takes: from one byte to before another.
Range = tuple[int, int]


def iter_members(file: IO[bytes], name: str, want: Want = everything, nested: bool = False, within: Range | None = None) -> Iterator[tuple[int, str, bytes]]:
    """(ordinal, path, content) of wanted members; ordinals count all entries in archive order.

    A damaged archive gives a warning and no further members.
    """
    for k, path, _, read in walk(file, name, want, nested, within=within):
        try:
            yield k, path, read()
        except _errors() as error:
            warnings.warn(f"{name}: {error}", stacklevel=2)
            return


#: Where a payload lies: offset, bytes there, how they are read (a zip's method, or one of those below), and unpacked bytes
#: between the start of the frame at the offset and the payload.
Place = tuple[int, int, int, int]
#: Bytes as they are at the offset; a member that is found by its ordinal only; bytes of a compressed stream, from the frame at the offset.
RAW, BY_ORDINAL, FRAME = -1, -2, -3
#: Compressed bytes that are unpacked at a time (a frame of zeros grows by thousands), and unpacked bytes of a gzip member at a time.
PIECE, UNPACKED = 8 << 10, 1 << 20
#: Endings of compressed tars.
GZIPPED, ZSTANDARD = (".gz", ".tgz"), (".zst",)


class Frames(io.RawIOBase):
    """The unpacked bytes of a gzip or zstandard file from the frame at ``start`` on, in one direction.

    ``began`` holds (unpacked, packed) starts of the frames read so far, the unpacked ones counted from ``start``.
    Zeros between gzip members are padding; other bytes after a frame that begin none end the file, as skippable
    frames do not.
    """

    def __init__(self, file: IO[bytes], zstandard: bool, start: int = 0):
        self.file, self.zstandard, self.packed, self.unpacked = file, zstandard, start, 0
        self.began: deque[tuple[int, int]] = deque()
        self.left, self.out, self.at, self.frame, self.over = b"", b"", 0, None, False
        file.seek(start)

    def readable(self) -> bool:
        return True

    def _opened(self) -> bool:
        """Begin the frame at the present place; False at the end of the file."""
        while True:
            if not self.zstandard:
                rest = self.left.lstrip(b"\0")
                self.packed, self.left = self.packed + len(self.left) - len(rest), rest
            if len(self.left) >= 4:
                break
            more = self.file.read(PIECE)
            if not more:
                break
            self.left += more
        if self.zstandard:
            import zstandard

            skippable = self.left[1:4] == b"\x2a\x4d\x18" and self.left[0] >> 4 == 5
            begins = self.left[:4] == zstandard.FRAME_HEADER or skippable
        else:
            begins = self.left[:2] == b"\x1f\x8b"
        if not begins:
            if self.packed == 0 and self.left:
                raise OSError("not a compressed file")
            return False
        self.frame = zstandard.ZstdDecompressor().decompressobj() if self.zstandard else zlib.decompressobj(31)
        self.began.append((self.unpacked, self.packed))
        return True

    def _more(self) -> bytes:
        """The next unpacked bytes; none at the end."""
        while not self.over:
            if self.frame is None and not self._opened():
                self.over = True
                break
            given = self.left or self.file.read(PIECE)
            if not given:
                raise EOFError("compressed file cut short")
            out = self.frame.decompress(given) if self.zstandard else self.frame.decompress(given, UNPACKED)
            self.left = self.frame.unused_data if self.frame.eof else b"" if self.zstandard else self.frame.unconsumed_tail
            self.packed += len(given) - len(self.left)
            self.unpacked += len(out)
            if self.frame.eof:
                self.frame = None
            if out:
                return out
        return b""

    def readinto(self, buffer: Any) -> int:
        if self.at == len(self.out):
            self.out, self.at = self._more(), 0
        data = memoryview(self.out)[self.at : self.at + len(buffer)]
        buffer[: len(data)] = data
        self.at += len(data)
        return len(data)

    @property
    def given(self) -> int:
        """Unpacked bytes handed out so far."""
        return self.unpacked - len(self.out) + self.at

    def pass_by(self, count: int) -> None:
        while count:
            if self.at == len(self.out):
                self.out, self.at = self._more(), 0
                if not self.out:
                    raise EOFError("cut short")
            step = min(count, len(self.out) - self.at)
            self.at, count = self.at + step, count - step

    def take(self, size: int) -> bytes:
        data = bytearray(size)
        view, have = memoryview(data), 0
        while have < size:
            step = self.readinto(view[have:])
            if not step:
                raise EOFError("cut short")
            have += step
        return bytes(data)

    def place_of(self, at: int) -> tuple[int, int]:
        """The packed start of the frame that holds unpacked byte ``at``, and the bytes between; ``at`` may only grow from call to call."""
        while len(self.began) > 1 and self.began[1][0] <= at:
            self.began.popleft()
        unpacked, packed = self.began[0]
        return packed, at - unpacked


def walk(file: IO[bytes], name: str, want: Want = everything, nested: bool = False, base: int = 0, within: Range | None = None) -> Iterator[tuple[int, str, Place, Callable[[], bytes]]]:
    """(ordinal, path, place, a function that reads the payload while the walk stands there) of wanted members.

    ``base`` is where ``file`` begins in the outermost archive.  Of a zip ``within`` takes the entries that begin there.
    """
    try:
        if name.endswith(ZIPS):
            yield from _zip_members(file, want, nested, base, within)
        else:
            yield from _tar_members(file, name, want, base)
    except _errors() as error:
        warnings.warn(f"{name}: {error}", stacklevel=2)


def data_start(file: IO[bytes], offset: int) -> int:
    """Where the data of a zip's entry begins, from its local header."""
    file.seek(offset)
    header = file.read(30)
    if header[:4] != b"PK\3\4":
        raise zipfile.BadZipFile("no entry where the directory says")
    return offset + 30 + int.from_bytes(header[26:28], "little") + int.from_bytes(header[28:30], "little")


def _zip_members(file: IO[bytes], want: Want, nested: bool, base: int, within: Range | None) -> Iterator[tuple[int, str, Place, Callable[[], bytes]]]:
    with zipfile.ZipFile(file) as z:
        for k, info in enumerate(z.infolist()):
            if info.is_dir() or within and not within[0] <= info.header_offset < within[1]:
                continue
            if nested and info.filename.endswith(".zip"):
                for j, path, place, read in _inner_members(file, z, info, want, base):
                    yield (k << 32) + j, f"{info.filename}/{path}", place, read
            elif want(info.filename):
                known = base >= 0 and info.compress_type in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED)
                place = (base + info.header_offset if known else 0, info.compress_size, info.compress_type if known else BY_ORDINAL, 0)
                yield (k << 32 if nested else k), info.filename, place, lambda info=info: z.read(info)


def _inner_members(file: IO[bytes], z: zipfile.ZipFile, info: zipfile.ZipInfo, want: Want, base: int) -> Iterator[tuple[int, str, Place, Callable[[], bytes]]]:
    wanted = lambda p: want(f"{info.filename}/{p}")
    if info.compress_type == zipfile.ZIP_STORED:
        start = data_start(file, info.header_offset)
        inside = io.BufferedReader(_Stretch(file, start, info.file_size), 1 << 20)
        yield from walk(inside, info.filename, wanted, base=base + start if base >= 0 else -1)
        return
    with _spooled(z, info) as spooled:
        yield from walk(spooled, info.filename, wanted, base=-1)


def _spooled(z: zipfile.ZipFile, info: zipfile.ZipInfo) -> IO[bytes]:
    """A compressed inner archive on the task's disk."""
    spooled = tempfile.TemporaryFile()  # noqa: SIM115  closed by the caller
    with z.open(info) as inner:
        while piece := inner.read(8 << 20):
            spooled.write(piece)
    spooled.seek(0)
    return spooled


def _tar_members(file: IO[bytes], name: str, want: Want, base: int) -> Iterator[tuple[int, str, Place, Callable[[], bytes]]]:
    frames = Frames(file, name.endswith(ZSTANDARD)) if name.endswith((*GZIPPED, *ZSTANDARD)) else None
    with tarfile.open(fileobj=frames and io.BufferedReader(frames, 1 << 20) or file, mode="r|" if frames or base < 0 else "r:") as t:
        for k, member in enumerate(t):
            if member.isfile() and want(member.name):
                place = (0, member.size, BY_ORDINAL, 0)
                if base >= 0 and not member.issparse():
                    offset, skip = frames.place_of(member.offset_data) if frames else (base + member.offset_data, 0)
                    place = (offset, member.size, FRAME if frames else RAW, skip)
                yield k, member.name, place, lambda member=member: t.extractfile(member).read()


def _row(archive: str, k: int, path: str, content: bytes) -> tuple[Any, ...]:
    size = loadable_size(content)
    return archive, k, path, content, *(size or (None, None))


def _batched(rows: Iterator[tuple[Any, ...]]) -> Iterator[pa.RecordBatch]:
    """Batches of MEMBERS, bounded in rows and in bytes."""
    names = [c.split()[0] for c in MEMBERS.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.int32()]
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
    waiting: list[tuple[Any, ...]] = []
    held = 0
    for row in rows:
        if waiting and held + len(row[3]) > BATCH_BYTES:
            yield batch(waiting)
            waiting, held = [], 0
        waiting.append(row)
        held += len(row[3])
        if len(waiting) == BATCH_ROWS:
            yield batch(waiting)
            waiting, held = [], 0
    if waiting:
        yield batch(waiting)


def _listed(batches: Iterator[pa.RecordBatch], want: Want, nested: bool) -> Iterator[pa.RecordBatch]:
    """The places of wanted members, by PLACES."""
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def batch(rows: list[tuple[Any, ...]]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], PLACE_COLUMNS)

    for archives in batches:
        for archive in archives.column(0).to_pylist():
            rows = []
            with open_file(archive) as file:
                for k, path, place, _ in walk(file, archive, want, nested):
                    rows.append((archive, k, path, *place))
                    if len(rows) == LISTED_ROWS:
                        yield batch(rows)
                        rows = []
            yield batch(rows)


class Payloads:
    """Reads payloads by their places; keeps the archive of the last one open, and a streamed one where it stands."""

    def __init__(self) -> None:
        self.archive: str | None = None
        self.file: IO[bytes] | None = None
        self.inner: tuple[str, IO[bytes]] | None = None
        self.at, self.last, self.stream = -1, None, None
        self.frames: Frames | None = None

    def read(self, archive: str, k: int, path: str, offset: int, size: int, method: int, skip: int) -> bytes | None:
        """The payload; None, with a warning, where the archive is damaged."""
        try:
            if archive != self.archive:
                self.close()
                self.archive, self.file = archive, open_file(archive)
            if method == BY_ORDINAL:
                return self._member(k, path) if archive.endswith(ZIPS) else self._streamed(k)
            if method == FRAME:
                return self._unpacked(offset, size, skip)
            self.file.seek(offset if method == RAW else data_start(self.file, offset))
            data = self.file.read(size)
            if len(data) < size:
                raise EOFError("cut short")
            return zlib.decompress(data, -15) if method == zipfile.ZIP_DEFLATED else data
        except _errors() as error:
            warnings.warn(f"{archive}: {path}: {error}", stacklevel=2)
            self.frames = None
            return None

    def _member(self, k: int, path: str) -> bytes:
        """A member of a zip, or of a compressed zip inside it, by its place in the listing."""
        with zipfile.ZipFile(self.file) as z:
            entries = z.infolist()
            if k < len(entries) and entries[k].filename == path:
                return z.read(entries[k])
            outer = entries[k >> 32]
            if outer.filename == path:
                return z.read(outer)
            if self.inner is None or self.inner[0] != outer.filename:
                if self.inner is not None:
                    self.inner[1].close()
                self.inner = (outer.filename, _spooled(z, outer))
        with zipfile.ZipFile(self.inner[1]) as z:
            return z.read(z.infolist()[k & 0xFFFFFFFF])

    def _unpacked(self, offset: int, size: int, skip: int) -> bytes:
        """Bytes of a compressed stream: it goes on where it stands, or begins at the frame where that is behind or nearer."""
        known = self.frames and next((u for u, p in self.frames.began if p == offset), None)
        ahead = -1 if known is None else known + skip - self.frames.given
        if ahead < 0:
            self.frames = Frames(self.file, self.archive.endswith(ZSTANDARD), offset)
            ahead = skip
        self.frames.pass_by(ahead)
        return self.frames.take(size)

    def _streamed(self, k: int) -> bytes | None:
        """A member of a compressed tar: the stream goes on to it, or starts again where it lies behind."""
        if k == self.at:
            return self.last
        if self.stream is None or k < self.at:
            self.file.seek(0)
            self.stream, self.at = walk(self.file, self.archive), -1
        for at, _, _, read in self.stream:
            if at == k:
                self.at, self.last = k, read()
                return self.last
        return None

    def close(self) -> None:
        for file in (self.file, self.inner and self.inner[1]):
            if file:
                file.close()
        self.archive, self.file, self.inner, self.stream, self.at, self.last = None, None, None, None, -1, None
        self.frames = None


def _filled(batches: Iterator[pa.RecordBatch], schema: pa.Schema, places: list[int], optional: bool) -> Iterator[pa.RecordBatch]:
    """Rows with their payloads and sizes, in batches bounded by bytes; without ``optional`` rows whose payload cannot be read go."""
    source = Payloads()

    def out(batch: pa.RecordBatch, rows: list[int], contents: list[bytes | None], sizes: list[tuple]) -> pa.RecordBatch:
        columns = batch.take(pa.array(rows)).columns
        added = [contents, [w for w, _ in sizes], [h for _, h in sizes]]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array(c, t) for c, t in zip(added, schema.types[-3:], strict=True))], schema.names)

    for batch in batches:
        rows, contents, sizes, held = [], [], [], 0
        for k, place in enumerate(zip(*(batch.column(c).to_pylist() for c in places), strict=True)):
            content = None if place[0] is None else source.read(*place)
            if content is None and not optional:
                continue
            if rows and (held + len(content or b"") > BATCH_BYTES or len(rows) == BATCH_ROWS):
                yield out(batch, rows, contents, sizes)
                rows, contents, sizes, held = [], [], [], 0
            rows.append(k)
            contents.append(content)
            sizes.append(loadable_size(content) or (None, None) if content is not None else (None, None))
            held += len(content or b"")
        if rows:
            yield out(batch, rows, contents, sizes)
    source.close()


def _arrays_filled(batches: Iterator[pa.RecordBatch], column: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows with ``payloads``, an array of content, width and height for each place of an array of places."""
    source = Payloads()
    kind = pa.list_(pa.struct([("content", pa.binary()), ("width", pa.int32()), ("height", pa.int32())]))
    for batch in batches:
        for k, places in enumerate(batch.column(column).to_pylist()):
            found = []
            for p in places or []:
                content = None if p is None or p["archive"] is None else p["content"] if "content" in p else source.read(*(p[c] for c in PLACE_COLUMNS))
                width, height = (loadable_size(content) or (None, None)) if content is not None else (None, None)
                found.append({"content": content, "width": width, "height": height})
            yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).columns, pa.array([found], kind)], [*names, "payloads"])
    source.close()


def _archives(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, bool]:
    """The archives at ``path``, and whether tasks can open them; where they cannot, their content comes along."""
    ship(spark)
    here = scheme_of(path if isinstance(path, str) else path[0]) in OPENED
    return spark.read.format("binaryFile").load(path).select("path", *([] if here else ["content"])), here


def list_members(spark: SparkSession, path: str | list[str], want: Want = everything, nested: bool = False) -> DataFrame:
    """The wanted members of the archives at ``path`` (a file, a folder's glob, or a list's common glob), by PLACES.

    From stores that only Spark's readers know, members come with their payloads.
    """
    files, here = _archives(spark, path)
    if here:
        return files.mapInArrow(lambda batches: _listed(batches, want, nested), PLACES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, archive in enumerate(batch.column(0).to_pylist()):
                with io.BytesIO(batch.column(1)[k].as_buffer()) as file:
                    yield from _batched(_row(archive, *member) for member in iter_members(file, archive, want, nested))

    members = files.mapInArrow(run, MEMBERS)
    return members.withColumns({"offset": F.lit(0).cast("long"), "size": F.lit(0).cast("long"), "method": F.lit(BY_ORDINAL)})


def place(members: DataFrame) -> Column:
    """The place of a listed member as one value, for ``with_payload_arrays``; with its payload where that came along."""
    return F.struct(*PLACE_COLUMNS, *(["content"] if "content" in members.columns else []))


def _dealt(rows: DataFrame, archive: Column, offset: Column, size: Column, streamed: Column, order: list[Column]) -> DataFrame:
    """``rows``, which hold places only, in tasks of about STRETCH bytes of payload; a streamed archive in one."""
    tasks = int((rows.agg(F.sum(size)).first()[0] or 0) // STRETCH) + 1
    return rows.repartition(min(tasks, MOST_TASKS), archive, F.when(~streamed, F.floor(offset / STRETCH))).sortWithinPartitions(*order)


def with_payloads(rows: DataFrame, optional: bool = False) -> DataFrame:
    """``rows`` (with the columns of PLACES) with content, width and height.

    The rows are shuffled as they are, without payloads.  A row whose payload cannot be read goes, with a warning;
    with ``optional`` it stays, as does a row without a place, with nulls.
    """
    if "content" in rows.columns:
        return rows
    rows = rows.drop("width", "height")
    at = [F.col(c) for c in ("archive", "offset", "size")]
    dealt = _dealt(rows, *at, F.col("method") == BY_ORDINAL, [F.col("archive"), F.col("offset"), F.col("ord")])
    kind = T.StructType([*rows.schema.fields, *_PAYLOAD.fields])
    places, schema = [rows.columns.index(c) for c in PLACE_COLUMNS], to_arrow_schema(kind)
    return dealt.mapInArrow(lambda batches: _filled(batches, schema, places, optional), kind)


def with_payload_arrays(rows: DataFrame, places: str) -> DataFrame:
    """``rows`` with ``payloads``, an array of structs (content, width, height) beside the array ``places`` of places."""
    first = F.get(places, F.lit(0))
    size = F.aggregate(places, F.lit(0).cast("long"), lambda total, p: total + F.coalesce(p["size"], F.lit(0)))
    dealt = _dealt(rows, first["archive"], first["offset"], size, first["method"] == BY_ORDINAL, [first["archive"], first["offset"], first["ord"]])
    kind = T.StructType([*rows.schema.fields, T.StructField("payloads", T.ArrayType(_PAYLOAD))])
    column, names = rows.columns.index(places), rows.columns
    return dealt.mapInArrow(lambda batches: _arrays_filled(batches, column, names), kind)


def read_members(spark: SparkSession, path: str, want: Want = everything, nested: bool = False) -> DataFrame:
    """The wanted members of the archives at ``path`` with their payloads, for members that need no numbering."""
    files, here = _archives(spark, path)
    if here and not nested and path.endswith(".zip"):
        return with_payloads(list_members(spark, path, want)).select(*(c.split()[0] for c in MEMBERS.split(", ")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, archive in enumerate(batch.column(0).to_pylist()):
                with open_file(archive) if here else io.BytesIO(batch.column(1)[k].as_buffer()) as file:
                    yield from _batched(_row(archive, *member) for member in iter_members(file, archive, want, nested))

    return files.mapInArrow(run, MEMBERS)


def read_csv_member(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The lines of the CSV member ``name`` of the archive at ``path``: their number ``n`` and a map ``row`` by header."""
    members = read_members(spark, path, lambda p: p == name or p.endswith("/" + name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                lines = csv.DictReader(io.TextIOWrapper(io.BytesIO(content.as_buffer()), "utf-8-sig", newline=""))
                rows = [[(k, v) for k, v in line.items() if k is not None and isinstance(v, str)] for line in lines]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.map_(pa.string(), pa.string()))], ["n", "row"])

    return members.select("content").mapInArrow(run, "n long, row map<string,string>")


def list_archives(pattern: str) -> list[tuple[str, int]]:
    """Path and size of the files whose names fit ``pattern``, by path; hidden names (``.`` or ``_`` first) are left out."""
    if scheme_of(pattern) == "file":
        found = [(p, os.path.getsize(p)) for p in glob.glob(re.sub("^file:/*", "/", pattern)) if os.path.isfile(p)]
    else:
        folder, _, names = pattern.rpartition("/")
        system, inner = system_of(folder)
        files = [i for i in system.get_file_info(fs.FileSelector(inner)) if i.type == fs.FileType.File]
        found = [(f"{folder}/{i.base_name}", i.size) for i in files if fnmatch.fnmatch(i.base_name, names)]
    return sorted((p, size) for p, size in found if p.rpartition("/")[2][:1] not in (".", "_"))


def stretches(path: str, start: int, stop: int) -> list[tuple[str, Range | None]]:
    """What tasks read of bytes ``start`` to ``stop`` of an archive: stretches of a zip, any other one whole."""
    if not path.endswith(ZIPS):
        return [(path, None)]
    return [(path, (at, min(at + STRETCH, stop))) for at in range(start, stop, STRETCH)]


class ArchiveSource(DataSource):
    """``spark.read.format("archive").option("suffixes", "png,jpg").load(glob)`` over stores that tasks can open.

    With ``readStream`` a stream over a folder that grows; see ``archive_stream``.
    """

    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema: Any) -> DataSourceReader:
        return _ArchiveReader(dict(self.options))

    def streamReader(self, schema: Any) -> DataSourceStreamReader:
        from corpusloom.sources.archive_stream import ArchiveStream

        return ArchiveStream(dict(self.options))


class MemberReader:
    """Reads the members that the options ``suffixes``, ``prefix`` and ``nested`` ask for."""

    def __init__(self, options: dict[str, str]):
        self.pattern = options["path"]
        self.suffixes = tuple(s for s in options.get("suffixes", "").lower().split(",") if s)
        self.prefix = options.get("prefix", "")
        self.nested = options.get("nested", "false") == "true"

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        want = lambda p: p.startswith(self.prefix) and (not self.suffixes or p.lower().endswith(self.suffixes))
        path, within = partition.value
        with open_file(path) as file:
            yield from _batched(_row(path, *member) for member in iter_members(file, path, want, self.nested, within))


class _ArchiveReader(MemberReader, DataSourceReader):
    def partitions(self) -> list[InputPartition]:
        return [InputPartition(part) for path, size in list_archives(self.pattern) for part in stretches(path, 0, size)]


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(ArchiveSource)
