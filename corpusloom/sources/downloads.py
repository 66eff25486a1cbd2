"""Downloads of tables of addresses into files, with retries and resumption.

A task fetches its addresses by a few threads.  What arrives goes to a part file beside the final name, with the
entity tag of the answer in a small file; an answer that is cut is asked for again from where it ended, and so
is a part that a run that died has left, under the condition that the tag is still the same.  Answers 429 and 5xx
wait as long as they say (``Retry-After``) or by doubling, five times at most; other answers are final.  A file gets its
name when it is whole, and names that are there are not fetched again.  Every run adds its rows
(address, name, bytes, tag, tries, status) to a state table; nothing passes through the driver.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from email.utils import parsedate_to_datetime
from http.client import HTTPException
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import tiles
from corpusloom.functions.text import retry_delays
from corpusloom.runtime import checkpoint, ship
from corpusloom.sources.archives import system_of
from corpusloom.state.tables import Downloads

#: Seconds of a request (fixed value), the first wait, and the longest one that an answer can ask for.
TIMEOUT, FACTOR, LONGEST_WAIT = 900.0, 1.5, 300.0
PIECE_BYTES = 1 << 20
DONE, GONE, FAILED = "done", "gone", "failed"
ROWS = "url string, name string, bytes long, etag string, tries int, status string, error string"


class _Target:
    """The files of one address in a store."""

    def __init__(self, folder: str, name: str):
        self.store, inner = system_of(folder)
        self.final = f"{inner.rstrip('/')}/{name}"
        below, _, last = self.final.rpartition("/")
        self.part, self.tag = f"{below}/.{last}.part", f"{below}/.{last}.etag"
        self.store.create_dir(below, recursive=True)

    def size(self, path: str) -> int | None:
        info = self.store.get_file_info(path)
        return info.size if info.type == fs.FileType.File else None

    def known(self) -> tuple[int, str | None]:
        """Bytes of the part and the tag they belong to; a part without a tag starts anew."""
        held = self.size(self.part)
        if not held or self.size(self.tag) is None:
            return 0, None
        with self.store.open_input_file(self.tag) as f:
            return held, f.read().decode()

    def begin(self, etag: str | None) -> Any:
        if etag:
            with self.store.open_output_stream(self.tag) as f:
                f.write(etag.encode())
        elif self.size(self.tag) is not None:
            self.store.delete_file(self.tag)
        return self.store.open_output_stream(self.part)

    def finish(self) -> int:
        size = self.size(self.part) or 0
        self.store.move(self.part, self.final)
        if self.size(self.tag) is not None:
            self.store.delete_file(self.tag)
        return size


def _wait_of(error: urllib.error.HTTPError) -> float | None:
    """The seconds that an answer asks to wait, None where it does not say."""
    said = error.headers.get("Retry-After")
    if said is None:
        return None
    try:
        seconds = float(said)
    except ValueError:
        try:
            seconds = parsedate_to_datetime(said).timestamp() - time.time()
        except ValueError:
            return None
    return min(max(0.0, seconds), LONGEST_WAIT)


def _receive(url: str, target: _Target, timeout: float) -> str | None:
    """One request: all of the file, or what is missing of its part; the tag.  A cut answer raises."""
    held, etag = target.known()
    asked = {"Range": f"bytes={held}-", "If-Range": etag} if held else {}
    with urllib.request.urlopen(urllib.request.Request(url, headers=asked), timeout=timeout) as answer:
        if answer.status == 206:
            out = target.store.open_append_stream(target.part)
        else:
            etag = answer.headers.get("ETag")
            out = target.begin(etag)
        with out:
            expected, got = answer.headers.get("Content-Length"), 0
            while piece := answer.read(PIECE_BYTES):
                out.write(piece)
                got += len(piece)
        if expected is not None and got < int(expected):
            raise HTTPException(f"cut after {got} of {expected} bytes")
    return etag


def fetch_file(url: str | None, name: str | None, folder: str, retries: int, factor: float, timeout: float) -> tuple:
    """One row of ROWS; the file is whole under its name, or only its part is there."""
    if not url or not name:
        return url, name, 0, None, 0, GONE, "no address or name"
    if not url.lower().startswith(("http://", "https://")):
        return url, name, 0, None, 0, GONE, "not an address of the web"
    target = _Target(folder, name)
    size = target.size(target.final)
    if size is not None:
        return url, name, size, None, 0, DONE, None
    error, tries = None, 0
    for wait in [0.0, *retry_delays(factor, retries)]:
        time.sleep(wait if error is None or not isinstance(error, urllib.error.HTTPError) or _wait_of(error) is None else _wait_of(error))
        tries += 1
        try:
            etag = _receive(url, target, timeout)
            return url, name, target.finish(), etag, tries, DONE, None
        except urllib.error.HTTPError as e:
            error = e
            if e.code == 416 and target.size(target.part):  # the part is whole already, or of another file: begin again
                target.store.delete_file(target.part)
            elif e.code != 429 and e.code < 500:
                return url, name, 0, None, tries, GONE, f"HTTP {e.code}"
        except (urllib.error.URLError, HTTPException, OSError) as e:
            error = e
        except ValueError as e:
            return url, name, 0, None, tries, GONE, str(e)
    return url, name, target.size(target.part) or 0, None, tries, FAILED, f"{type(error).__name__}: {error}"


def download(
    spark: SparkSession, rows: DataFrame, folder: str, state: str, retries: int = 5, factor: float = FACTOR, timeout: float = TIMEOUT, in_flight: int = 8, tasks: int | None = None
) -> DataFrame:
    """Fetch ``rows`` (url, name) into ``folder``; a row of ROWS for each that this run tried.

    Addresses that the state table holds as done or gone are passed over, of rows with one name one counts.
    """
    ship(spark)
    table = Downloads(spark, state)
    over = table.read().filter(F.col("status").isin(DONE, GONE)).select("name").distinct()
    left = rows.select("url", "name").dropDuplicates(["name"]).join(over, "name", "left_anti").select("url", "name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in ROWS.split(", ")]
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string()]
        with ThreadPoolExecutor(in_flight) as pool:
            for batch in batches:
                pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
                for start in range(0, len(pairs), 8 * in_flight):
                    found = list(pool.map(lambda p: fetch_file(*p, folder, retries, factor, timeout), pairs[start : start + 8 * in_flight]))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names)

    dealt = left.repartition(tasks, "name") if tasks else left.repartition("name")
    made = checkpoint(dealt.mapInArrow(run, ROWS))
    table.append(made)
    return made


def report(made: DataFrame) -> DataFrame:
    """Files, bytes and tries by status."""
    return made.groupBy("status").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("tries").alias("tries"))


def tile_addresses(found: DataFrame, server: str) -> DataFrame:
    """url and name of each tile (zoom, x, y) of a tile server."""
    part: Column = F.concat_ws("/", F.lit(server.rstrip("/")), "zoom", "x", F.concat(F.col("y").cast("string"), F.lit(".png")))
    return found.select(part.alias("url"), tiles.tile_file(F.col("zoom"), F.col("x"), F.col("y")).alias("name"))


def scrape_tiles(spark: SparkSession, server: str, folder: str, state: str, box: tuple[float, float, float, float] = tiles.DEFAULT_BOX, zoom: int = 8, ratio: float = 1.0, seed: int = 0, **options: Any) -> DataFrame:
    """The tiles of a box, or a seeded share of them, as files."""
    found = tiles.tiles_of(spark, box, zoom)
    chosen = found if ratio >= 1 else tiles.sample_tiles(found, ratio, seed)
    return download(spark, tile_addresses(chosen, server), folder, state, **options)
