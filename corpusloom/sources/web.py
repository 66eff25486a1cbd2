"""Documents of JSON lines inside nested archives, the image addresses in them, and their fetching."""

from __future__ import annotations

import urllib.error
import urllib.request
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import ship

#: Seconds to wait for a connection or for data (fixed value of the connection timeout).
TIMEOUT = 5.0


def json_lines(members: DataFrame) -> DataFrame:
    """archive, ord, line_no and the parsed ``doc`` of each line of the members; unreadable lines go."""
    lines = members.select("archive", "ord", F.posexplode(F.split(F.col("content").cast("string"), "\n")).alias("line_no", "line"))
    return lines.withColumn("doc", F.try_parse_json("line")).filter("doc IS NOT NULL").drop("line")


def image_addresses(docs: DataFrame) -> DataFrame:
    """One row for each non-empty ``raw_url`` of the documents' ``image_info``, with its place."""
    urls = F.from_json(F.to_json("doc"), "image_info array<struct<raw_url:string>>")["image_info"]["raw_url"]
    keys = [c for c in docs.columns if c != "doc"]
    return docs.select(*keys, F.posexplode(urls).alias("k", "url")).filter("url IS NOT NULL AND url != ''")


def _fetch(url: str, timeout: float) -> bytes | None:
    try:
        with urllib.request.urlopen(url, timeout=timeout) as answer:
            return answer.read() if answer.status == 200 else None
    except (urllib.error.URLError, OSError, ValueError):
        return None


def fetch(rows: DataFrame, url: str = "url", in_flight: int = 32, timeout: float = TIMEOUT) -> DataFrame:
    """``rows`` with ``content``, fetched by threads in each task; failures and other statuses drop the row.

    Ids should be assigned before, as answers arrive in no fixed order; rows keep theirs here.
    """
    ship(rows.sparkSession)
    at, names = rows.columns.index(url), [*rows.columns, "content"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", content binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(in_flight) as pool:
            for batch in batches:
                for start in range(0, batch.num_rows, in_flight):
                    part = batch.slice(start, in_flight)
                    data = list(pool.map(lambda u: None if u is None else _fetch(u, timeout), part.column(at).to_pylist()))
                    got = pa.array([d is not None for d in data])
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], names).filter(got)

    return rows.mapInArrow(run, schema)
