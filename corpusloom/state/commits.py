"""One commit for a sink and all state of a run.

What a stretch of a run makes is first written where no reader looks: files in a staging folder, rows of
state tables in pending folders.  Then one record, put in place by one rename, names all of it with the places where it
belongs; from then on the stretch has happened.  Publishing moves each part to its place and may be done
again: a run begins by publishing the last record, so a death before the record leaves nothing and one
after it loses nothing.  One run at a time writes a log.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession

#: Where something lies, and where it belongs.
Move = list[str]


def _system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names of files and folders in a folder, sorted; none where there is no folder."""
    system, path = _system(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []


def files_below(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Paths, relative to ``folder``, of the files with a suffix anywhere below it."""
    system, path = _system(spark, folder)
    if not system.exists(path):
        return []
    top, found, each = system.getFileStatus(path).getPath().toString() + "/", [], system.listFiles(path, True)
    while each.hasNext():
        name = each.next().getPath().toString()
        if name.endswith(suffix):
            found.append(name.removeprefix(top))
    return sorted(found)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, None where there is none."""
    system, where = _system(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def put(spark: SparkSession, path: str, content: str) -> None:
    """Write a small file under a temporary name, then give it its own."""
    system, final = _system(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{final.getParent().toString()}/.{final.getName()}.{uuid.uuid4().hex}")
    out = system.create(part, True)
    out.write(bytearray(content.encode()))
    out.close()
    system.delete(final, False)
    system.rename(part, final)


def remove(spark: SparkSession, path: str) -> None:
    system, where = _system(spark, path)
    system.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Bring a file or folder to its place; nothing where that has been done."""
    system, here = _system(spark, source)
    if not system.exists(here):
        return
    _, there = _system(spark, target)
    system.mkdirs(there.getParent())
    if system.exists(there):
        system.delete(there, True)
    if not system.rename(here, there):
        raise OSError(f"cannot move {source} to {target}")


def publish(spark: SparkSession, moves: list[Move], puts: dict[str, str]) -> None:
    """Bring all parts to their places; may be repeated."""
    for source, target in moves:
        move(spark, source, target)
    for path, content in puts.items():
        put(spark, path, content)


class CommitLog:
    """Numbered records of a run in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}/commits"

    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in names_in(self.spark, self.path) if n.endswith(".json") and n[:-5].isdigit()]

    def last(self) -> dict[str, Any] | None:
        numbers = self.numbers()
        return json.loads(read_text(self.spark, f"{self.path}/{numbers[-1]:012d}.json") or "null") if numbers else None

    def commit(self, moves: list[Move], puts: dict[str, str], **about: Any) -> dict[str, Any]:
        """The record's rename is the commit; publishing follows."""
        number = (self.numbers() or [0])[-1] + 1
        record = {"number": number, "moves": moves, "puts": puts, **about}
        put(self.spark, f"{self.path}/{number:012d}.json", json.dumps(record))
        return record

    def publish(self, record: dict[str, Any]) -> None:
        publish(self.spark, record["moves"], record["puts"])

    def recover(self) -> None:
        """Publish what the last run committed and may not have published."""
        record = self.last()
        if record is not None:
            self.publish(record)
