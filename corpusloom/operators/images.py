"""Filters that look at pixels: downsampling and perceptual dedup, and the registry of filters."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import imghash, pixels
from corpusloom.operators import decoding, dedup, filters
from corpusloom.runtime import ship

Filter = Callable[[DataFrame], DataFrame]
#: Grid sizes (width, height) of the hashes (fixed values).
GRIDS = {"phash": (32, 32), "dhash": (9, 8), "ahash": (8, 8)}
#: Names of resampling kinds by number (fixed values).
RESAMPLING = {0: "nearest", 1: "lanczos", 2: "bilinear", 3: "bicubic", 4: "box", 5: "hamming"}


def hash_png(data: bytes | None, algorithm: str) -> str | None:
    """The perceptual hash of an image; None where it cannot be decoded."""
    rgb = pixels.decode_png(data)
    if rgb is None:
        return None
    return getattr(imghash, algorithm)(pixels.resize(pixels.to_gray(rgb), *GRIDS[algorithm]))


def downsample(max_pixels: int, pil_resample: int = 1) -> Filter:
    """Bring single images of more than ``max_pixels`` down; their bytes become PNG.

    Images that cannot be decoded stay as they are.
    """
    if pil_resample not in RESAMPLING:
        raise ValueError(f"unknown resampling {pil_resample}")
    kind = RESAMPLING[pil_resample]

    def apply(df: DataFrame) -> DataFrame:
        ship(df.sparkSession)

        @F.pandas_udf("binary")
        def shrink(data: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
            out = []
            for d, w, h in zip(data, width, height, strict=True):
                image = None if d is None else pixels.decode_png(d)
                out.append(d if image is None or (image.shape[1], image.shape[0]) == (w, h) else pixels.encode_png(pixels.resize(image, int(w), int(h), kind)))
            return pd.Series(out)

        first = F.get("images", F.lit(0))
        width, height = filters.scaled(first["width"].cast("long"), first["height"].cast("long"), max_pixels)
        over = filters.is_single_image() & (first["width"].cast("long") * first["height"] > max_pixels)
        small = df.filter(over).withColumns({"_w": width.cast("int"), "_h": height.cast("int"), "_b": first["bytes"]})
        small = decoding.as_png(small, "_b").withColumn("_b", shrink("_b", "_w", "_h"))
        scaled = F.array(F.struct(F.col("_b").alias("bytes"), F.lit("png").alias("format"), F.col("_w").alias("width"), F.col("_h").alias("height")))
        image = F.when(F.col("_b").isNotNull(), scaled).otherwise(F.col("images"))
        return df.filter(~F.coalesce(over, F.lit(False))).unionByName(small.withColumn("images", image).drop("_w", "_h", "_b"))

    return apply


def with_image_hash(df: DataFrame, algorithm: str) -> DataFrame:
    """``img_hash`` of single images, null for other samples."""
    if algorithm not in GRIDS:
        raise ValueError(f"unknown hash {algorithm!r}")
    ship(df.sparkSession)

    @F.pandas_udf("string")
    def hashed(data: pd.Series) -> pd.Series:
        return data.map(lambda d: None if d is None else hash_png(d, algorithm))

    single = df.withColumn("_b", F.when(filters.is_single_image(), F.get("images", F.lit(0))["bytes"]))
    return decoding.as_png(single, "_b").withColumn("img_hash", hashed("_b")).drop("_b")


def deduplication(db_path: str | None = None, algorithm: str = "phash") -> Filter:
    """The first single image of each hash, and of the store's hashes only their owner.

    New owners are appended to the store by the run after its sink has committed (``new_owners``).
    """

    def apply(df: DataFrame) -> DataFrame:
        from corpusloom.state.tables import HashStore

        keyed = with_image_hash(df, algorithm)
        if db_path is not None:
            keyed = dedup.against_store(keyed, HashStore(df.sparkSession, db_path).read(), "img_hash", ["dataset_id", "sample_id"])
        return dedup.first_wins(keyed, F.col("img_hash"), "adapter_pos", "src_ord").drop("img_hash")

    return apply


FILTERS: dict[str, Callable[..., Filter]] = {"ImageResolution": filters.resolution, "ImageDownsample": downsample, "ImageDeduplication": deduplication}


def build(config: dict[str, object]) -> Filter:
    """One filter from its configuration entry; an unknown id is an error."""
    options = dict(config)
    name = str(options.pop("id"))
    if name not in FILTERS:
        raise ValueError(f"unknown filter {name!r}; known: {', '.join(sorted(FILTERS))}")
    return FILTERS[name](**options)
