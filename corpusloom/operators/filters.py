"""Row filters over the canonical sample, bound from configuration by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sample types that image filters and the Arrow sink look at; others pass filters and leave that sink.
GATED_TYPES = ("image", "image_text")


def is_single_image(sample_type: Column | None = None) -> Column:
    return (F.col("sample_type") if sample_type is None else sample_type).isin(*GATED_TYPES)


def within(value: Column, low: int | None, high: int | None) -> Column:
    """Inclusive bounds, each optional."""
    out = F.lit(True)
    if low is not None:
        out = out & (value >= low)
    if high is not None:
        out = out & (value <= high)
    return out


def resolution(min_width: int | None = None, min_height: int | None = None, max_width: int | None = None, max_height: int | None = None) -> Callable[[DataFrame], DataFrame]:
    """Keep single images inside the bounds; other samples pass."""

    def apply(df: DataFrame) -> DataFrame:
        image = F.get("images", F.lit(0))
        fits = within(image["width"], min_width, max_width) & within(image["height"], min_height, max_height)
        return df.filter(~is_single_image() | F.coalesce(fits, F.lit(False)))

    return apply


def scaled(width: Column, height: Column, max_pixels: int) -> tuple[Column, Column]:
    """The size of an image brought down to at most ``max_pixels``, each side truncated."""
    scale = F.sqrt(F.lit(float(max_pixels)) / (width * height))
    over = width * height > max_pixels
    side = lambda v: F.when(over, F.floor(v * scale).cast("long")).otherwise(v.cast("long"))
    return side(width), side(height)


def match_all(filters: list[Callable[[DataFrame], DataFrame]]) -> Callable[[DataFrame], DataFrame]:
    """Filters in order; one may occur several times."""

    def apply(df: DataFrame) -> DataFrame:
        for f in filters:
            df = df.transform(f)
        return df

    return apply
