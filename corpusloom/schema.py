"""The canonical sample: one row for text, one image, one image with text, or several images with text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_TYPES = ("text", "image", "image_text", "multi_image_text")

IMAGE = T.StructType(
    [
        T.StructField("bytes", T.BinaryType()),
        T.StructField("format", T.StringType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
    ]
)

SAMPLE = T.StructType(
    [
        T.StructField("dataset_id", T.StringType()),
        T.StructField("sample_id", T.LongType()),
        T.StructField("sample_type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("images", T.ArrayType(IMAGE)),
        T.StructField("data", T.MapType(T.StringType(), T.StringType())),
        T.StructField("adapter_pos", T.IntegerType()),
        T.StructField("src_ord", T.LongType()),
    ]
)


def as_samples(df: DataFrame, dataset_id: str, sample_type: str, *, text: Column | None = None, images: Column | None = None, data: Column | None = None) -> DataFrame:
    """``df`` (with ``sample_id``) as canonical samples, to be numbered by configuration order later."""
    if sample_type not in SAMPLE_TYPES:
        raise ValueError(f"unknown sample type {sample_type!r}")
    none = lambda name: F.lit(None).cast(SAMPLE[name].dataType)
    return df.select(
        F.lit(dataset_id).alias("dataset_id"),
        F.col("sample_id").cast("long").alias("sample_id"),
        F.lit(sample_type).alias("sample_type"),
        (none("text") if text is None else text).alias("text"),
        (none("images") if images is None else images).alias("images"),
        (none("data") if data is None else data).alias("data"),
        F.lit(0).alias("adapter_pos"),
        F.col("sample_id").cast("long").alias("src_ord"),
    )


def serialize(df: DataFrame) -> DataFrame:
    """Samples as JSON, images in base 64."""
    return df.select("dataset_id", "sample_id", F.to_json(F.struct(*df.columns)).alias("payload"))


def deserialize(df: DataFrame) -> DataFrame:
    """Samples from JSON; an unknown sample type is an error."""
    rows = df.select(F.from_json("payload", SAMPLE.simpleString()).alias("s")).select("s.*")
    known = F.col("sample_type").isin(*SAMPLE_TYPES)
    message = F.concat(F.lit("unknown sample type "), F.coalesce("sample_type", F.lit("null")))
    return rows.withColumn("sample_type", F.when(known, F.col("sample_type")).otherwise(F.raise_error(message).cast("string")))
