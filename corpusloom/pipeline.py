"""A run from a JSON configuration: adapters, filters, writer, state.

The configuration has ``adapters`` and ``filters`` (lists of entries with an ``id``), ``writer`` (with
a ``type``) and ``pipeline`` (``log_file``, ``manifest_db``, ``checkpoint_db``, ``num_workers``,
``batch_size``, and ``commit_batches``, the batches between two commits).  Datasets run one after another; complete ones are
skipped, others resume after their last sample.  Each stretch of batches is one commit of files, totals, manifest, hash
owners and progress (``state.commits``): a run that dies leaves each sample once, and repeats the work of one stretch at most.
"""

from __future__ import annotations

import json
import logging
import os
import sys
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import images as image_filters
from corpusloom.operators.filters import match_all
from corpusloom.runtime import discard, stored
from corpusloom.sinks.shards import STAGING, WRITERS
from corpusloom.sources import adapters
from corpusloom.state.commits import CommitLog, names_in, remove
from corpusloom.state.tables import HashStore, Manifest, Progress

LOG_FORMAT = "%(asctime)s %(levelname)s [%(name)s] %(message)s"
#: Batches that are written and committed together, unless the configuration says otherwise.
COMMIT_BATCHES = 1000
REQUIRED = ("log_file", "manifest_db", "checkpoint_db", "num_workers", "batch_size")


def logger_for(log_file: str | None) -> logging.Logger:
    """The run's logger: information on the console, everything in the file."""
    log = logging.getLogger("pipeline")
    log.setLevel(logging.DEBUG)
    log.handlers.clear()
    console = logging.StreamHandler(sys.stdout)
    console.setLevel(logging.INFO)
    handlers: list[logging.Handler] = [console]
    if log_file:
        os.makedirs(os.path.dirname(log_file) or ".", exist_ok=True)
        handlers.append(logging.FileHandler(log_file))
    for handler in handlers:
        handler.setFormatter(logging.Formatter(LOG_FORMAT))
        log.addHandler(handler)
    return log


def load_config(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return checked(json.load(f))


def checked(config: dict) -> dict:
    """The configuration with every part in place; missing keys and unknown names are errors."""
    for key in ("adapters", "writer", "pipeline"):
        if key not in config:
            raise KeyError(key)
    for key in REQUIRED:
        if key not in config["pipeline"]:
            raise KeyError(f"pipeline.{key}")
    kind = config["writer"].get("type", "huggingface")
    if kind not in WRITERS:
        raise ValueError(f"unknown writer {kind!r}; known: {', '.join(WRITERS)}")
    return {"filters": [], **config}


def stretches(low: int | None, newest: int | None, size: int) -> Iterator[tuple[int, int, bool]]:
    """First and last id of each stretch of ``size`` ids, and whether it is the last one."""
    for first in range(low, newest + 1, size) if low is not None and newest is not None else ():
        end = min(first + size - 1, newest)
        yield first, end, end == newest


def run(spark: SparkSession, config: dict, debug: bool = False, source: Callable[..., DataFrame] = adapters.build) -> dict[str, dict[str, int]]:
    """Run all datasets and return processed and passed counts by dataset.

    ``debug`` handles the first batch of each dataset and leaves it incomplete.
    """
    config = checked(config)
    options = config["pipeline"]
    log = logger_for(options["log_file"])
    log_of = CommitLog(spark, options["checkpoint_db"])
    manifest, progress = Manifest(spark, options["manifest_db"]), Progress(spark, options["checkpoint_db"])
    writer = dict(config["writer"])
    sink = WRITERS[writer.pop("type", "huggingface")]
    apply = match_all([image_filters.build(f) for f in config["filters"]])
    stores = [(HashStore(spark, f["db_path"]), f.get("algorithm", "phash")) for f in config["filters"] if f["id"] == "ImageDeduplication" and f.get("db_path")]
    log_of.recover()
    for table in (manifest, progress, *(s for s, _ in stores)):
        table.sweep()
        table.compact()
    for name in names_in(spark, writer["output_dir"]):
        if name.startswith(STAGING):
            remove(spark, f"{writer['output_dir']}/{name}")
    out: dict[str, dict[str, int]] = {}
    for position, entry in enumerate(config["adapters"]):
        samples = source(spark, entry, position)
        name = samples.select("dataset_id").first()
        name = name[0] if name else str(entry.get("dataset_id", entry["id"]))
        last, complete = progress.get(name)
        if complete:
            log.info("%s is complete", name)
            continue
        if last is not None:
            samples = samples.filter(F.col("sample_id") > last)
        if debug:
            samples = samples.orderBy("src_ord").limit(int(options["batch_size"]))
        # Both are counted while they are written.
        read, left = Observation(), Observation()
        samples = stored(samples.observe(read, F.count(F.lit(1)).alias("n"), F.min("sample_id").alias("low"), F.max("sample_id").alias("newest")))
        processed, low, newest = (read.get[c] for c in ("n", "low", "newest"))
        log.info("%s: read %d samples", name, processed)
        kept = stored(samples.transform(apply).observe(left, F.count(F.lit(1)).alias("n"))) if config["filters"] else samples
        passed = left.get["n"] if config["filters"] else processed
        for first, end, final in stretches(low, newest, int(options["batch_size"]) * int(options.get("commit_batches", COMMIT_BATCHES))):
            part = kept.filter(F.col("sample_id").between(first, end))
            moves, puts, staging = [], {}, f"{writer['output_dir']}/{STAGING}{uuid.uuid4().hex}"
            if not part.isEmpty():
                staged = sink.stage(part, staging=staging, batch_size=int(options["batch_size"]), **writer)
                moves, puts = staged.moves, staged.puts
                moves.append(manifest.add(part, staged=True))
                for store, algorithm in stores:
                    moves.append(store.add(image_filters.with_image_hash(part, algorithm).filter("img_hash IS NOT NULL"), staged=True))
            moves.append(progress.update(name, end, completed=final and not debug, staged=True))
            log_of.publish(log_of.commit(moves, puts, dataset=name, first=first, end=end))
            remove(spark, staging)
            log.info("%s: committed up to sample %d of %d", name, end, newest)
        if newest is None:
            progress.update(name, last, completed=not debug)
        out[name] = {"processed": processed, "passed": passed}
        log.info("%s: %d of %d samples passed", name, passed, processed)
        for rows in {id(samples): samples, id(kept): kept}.values():
            discard(rows)
    return out


def main(argv: list[str] | None = None) -> None:
    from corpusloom.runtime import session

    arguments = sys.argv[1:] if argv is None else argv
    run(session("corpusloom"), load_config(arguments[0]), debug=os.environ.get("PIPELINE_DEBUG") == "1")


if __name__ == "__main__":
    main()
