"""Rows into archives: zips, zips inside zips, tars, and compressed tars in frames that can be read apart.

A task streams the sorted rows of an archive into it and holds one member at a time; an archive gets its name when it
is complete.  Compressed tars are cut into frames of FRAME unpacked bytes, so that readers can start at any of them.
"""

from __future__ import annotations

import gzip
import io
import tarfile
import zipfile
from contextlib import ExitStack
from typing import IO

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import ship
from corpusloom.sinks.shards import SharedFile, written

#: Unpacked bytes of a frame of a compressed tar.
FRAME = 4 << 20


class ZipPacker(SharedFile):
    """A zip; members below ``x.zip/`` go into a zip ``x.zip`` that is stored in it, those of one inner zip in a row."""

    def __init__(self, folder: str, name: str):
        super().__init__(folder, name)
        self.outer = zipfile.ZipFile(self.out, "w", zipfile.ZIP_DEFLATED)
        self.inner: tuple[str, zipfile.ZipFile, ExitStack] | None = None

    def _inside(self, name: str) -> tuple[zipfile.ZipFile, str]:
        folder, found, rest = name.partition(".zip/")
        if self.inner is not None and (not found or self.inner[0] != folder):
            self.inner[2].close()
            self.inner = None
        if not found:
            return self.outer, name
        if self.inner is None:
            with ExitStack() as stack:
                entry = stack.enter_context(self.outer.open(zipfile.ZipInfo(folder + ".zip"), "w", force_zip64=True))
                inside = stack.enter_context(zipfile.ZipFile(entry, "w", zipfile.ZIP_DEFLATED))
                self.inner = (folder, inside, stack.pop_all())
        return self.inner[1], rest

    def write(self, rows: pa.RecordBatch) -> None:
        for name, content in zip(rows.column("name").to_pylist(), rows.column("content"), strict=True):
            archive, path = self._inside(name)
            data = content.as_py() or b""
            archive.writestr(zipfile.ZipInfo(path), data, zipfile.ZIP_DEFLATED)
            self.bytes += len(data)
        self.samples += rows.num_rows

    def finish(self) -> None:
        if self.inner is not None:
            self.inner[2].close()
        self.outer.close()
        super().finish()


class _Framed(io.RawIOBase):
    """Writes what it gets in frames, each packed by itself."""

    def __init__(self, out: IO[bytes], zstd: bool):
        self.out, self.zstd, self.held = out, zstd, bytearray()

    def writable(self) -> bool:
        return True

    def write(self, data: bytes) -> int:
        self.held += data
        while len(self.held) >= FRAME:
            self._pack(bytes(self.held[:FRAME]))
            del self.held[:FRAME]
        return len(data)

    def _pack(self, data: bytes) -> None:
        if self.zstd:
            import zstandard

            self.out.write(zstandard.ZstdCompressor(write_checksum=True).compress(data))
        else:
            self.out.write(gzip.compress(data, mtime=0))

    def end(self) -> None:
        if self.held:
            self._pack(bytes(self.held))
            self.held = bytearray()


class TarPacker(SharedFile):
    """A tar, plain or compressed, by its name."""

    def __init__(self, folder: str, name: str):
        super().__init__(folder, name)
        self.framed = None if name.endswith(".tar") else _Framed(self.out, name.endswith(".zst"))
        self.tar = tarfile.open(fileobj=self.framed or self.out, mode="w|")  # noqa: SIM115  closed by finish

    def write(self, rows: pa.RecordBatch) -> None:
        for name, content in zip(rows.column("name").to_pylist(), rows.column("content"), strict=True):
            data = content.as_py() or b""
            info = tarfile.TarInfo(name)
            info.size = len(data)
            self.tar.addfile(info, io.BytesIO(data))
            self.bytes += len(data)
        self.samples += rows.num_rows

    def finish(self) -> None:
        self.tar.close()
        if self.framed is not None:
            self.framed.end()
        super().finish()


PACKERS = {".zip": ZipPacker, ".tar": TarPacker, ".tar.gz": TarPacker, ".tgz": TarPacker, ".tar.zst": TarPacker}


def ending(name: str) -> str:
    """The ending that says how an archive is packed."""
    for known in PACKERS:
        if name.endswith(known):
            return known
    raise ValueError(f"{name}: archives end in {', '.join(PACKERS)}")


def pack(rows: DataFrame, folder: str, archive: Column, name: Column, content: Column, order: list[Column]) -> list[list]:
    """Write ``content`` (null: empty) under ``name`` into the archives that ``archive`` names, members by ``order``.

    Returns a list of "", name of the archive, members, bytes for each.  Rows without a name of an archive or of a
    member are an error, as is a name of another ending.  An archive is written by one task, so names should spread the rows.
    """
    ship(rows.sparkSession)
    named = lambda c, what: F.when(c.isNotNull(), c).otherwise(F.raise_error(F.lit(f"a row without the name of its {what}")))
    keys = [f"_by{k}" for k in range(len(order))]
    light = rows.select(named(archive, "archive").alias("archive"), named(name, "member").alias("name"), content.cast("binary").alias("content"), *(c.alias(k) for c, k in zip(order, keys, strict=True)))
    return written(light, ["archive"], [*keys, "name"], "packed", folder, {})
