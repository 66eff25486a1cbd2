"""Images of other formats as PNG, decoded by Spark's ``image`` source.

The pixel kernels of the engine read PNG.  JPEG, GIF, BMP and TIFF images are written as files to the
shared folder, each content once, and read back by the ``image`` source, whose decoder runs in the JVM on
the executors.  What that cannot decode comes out null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import pixels
from corpusloom.runtime import scratch_folder, ship, stored
from corpusloom.sources.archives import OPENED, scheme_of


def _writer(folder: str):
    """A function of batches (name, content) that writes files and returns their names."""
    scheme = scheme_of(folder)
    if scheme not in OPENED:
        raise ValueError(f"tasks cannot write to {folder}; set spark.checkpoint.dir to a store of {', '.join(OPENED)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if scheme == "file":
            system, inner = fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
        else:
            system, inner = fs.FileSystem.from_uri("s3" + folder.removeprefix("s3a") if scheme == "s3a" else folder)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with system.open_output_stream(f"{inner}/{name}") as out:
                    out.write(content.as_buffer())
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["name"])

    return run


def _encoded(data: pd.Series, width: pd.Series, height: pd.Series, channels: pd.Series) -> pd.Series:
    """PNG of rows of gray or of blue, green, red (and alpha) bytes."""
    out = []
    for d, w, h, c in zip(data, width, height, channels, strict=True):
        image = np.frombuffer(d, np.uint8).reshape(h, w, c)
        out.append(pixels.encode_png(np.repeat(image, 3, axis=2) if c == 1 else image[:, :, 2::-1]))
    return pd.Series(out)


def as_png(df: DataFrame, column: str) -> DataFrame:
    """``df`` with the images of ``column`` as PNG: PNG and null stay, others are decoded, null where that fails."""
    spark = df.sparkSession
    ship(spark)
    other = F.col(column).isNotNull() & (F.substring(column, 1, 8) != F.lit(bytearray(pixels.PNG_MAGIC)))
    named = df.withColumn("_image", F.when(other, F.sha2(column, 256)))
    found = named.filter("_image IS NOT NULL").select("_image", column).dropDuplicates(["_image"])
    folder = scratch_folder(spark, "images")
    if not found.mapInArrow(_writer(folder), "name string").count():
        return named.drop("_image")
    images = spark.read.format("image").option("dropInvalid", "true").option("ignoreCorruptFiles", "true").load(folder).select("image.*")
    name = F.regexp_extract("origin", r"([0-9a-f]{64})$", 1)
    encoded = F.pandas_udf(_encoded, "binary")
    decoded = stored(images.select(name.alias("_image"), encoded("data", "width", "height", "nChannels").alias("_png")))
    joined = named.join(decoded, "_image", "left")
    return joined.withColumn(column, F.when(F.col("_image").isNull(), F.col(column)).otherwise(F.col("_png"))).select(*df.columns)
