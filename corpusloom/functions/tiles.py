"""Map tiles: coordinates, enumeration of a bounding box, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.sampling import exact_sample

#: Degrees: least and greatest longitude and latitude of the default box (fixed values).
DEFAULT_BOX = (120.0, 21.0 + 53 / 60, 122.0, 25.0 + 18 / 60)


def tile_x(lon: Column, zoom: Column) -> Column:
    return F.floor((lon + 180.0) / 360.0 * F.pow(F.lit(2.0), zoom)).cast("long")


def tile_y(lat: Column, zoom: Column) -> Column:
    return F.floor((1.0 - F.asinh(F.tan(F.radians(lat))) / F.pi()) / 2.0 * F.pow(F.lit(2.0), zoom)).cast("long")


Bounds = tuple[Column, Column, Column, Column]


def tiles_in(rows: DataFrame, box: Bounds, zoom: int = 8) -> DataFrame:
    """``rows`` with zoom, x and y for each tile of its box (west, south, east, north); rows of tiles grow downwards."""
    west, south, east, north = box
    z = F.lit(zoom)
    wide = rows.withColumns({"zoom": z, "_top": tile_y(north, z), "_bottom": tile_y(south, z), "x": F.explode(F.sequence(tile_x(west, z), tile_x(east, z)))})
    return wide.withColumn("y", F.explode(F.sequence("_top", "_bottom"))).drop("_top", "_bottom")


def tiles_of(spark: SparkSession, box: tuple[float, float, float, float] = DEFAULT_BOX, zoom: int = 8) -> DataFrame:
    """zoom, x, y of all tiles of one box."""
    return tiles_in(spark.range(1).select(), tuple(map(F.lit, box)), zoom)


def sample_tiles(tiles: DataFrame, ratio: float, seed: int = 0) -> DataFrame:
    """``int(n * ratio)`` tiles in a fixed pseudo-random choice, in the order of x and y."""
    drawn = F.md5(F.concat_ws("/", "x", "y", F.lit(seed)).cast("binary"))
    return exact_sample(tiles, drawn, ["x", "y"], ratio=ratio).orderBy("x", "y")


def slices_in(rows: DataFrame, box: Bounds, step: int) -> DataFrame:
    """``rows`` with the bounds (w, s, e, n) and file name of each grid cell of its box."""
    west, south, east, north = (b.cast("long") for b in box)
    wide = rows.withColumns({"_east": east, "_south": south, "_north": north, "w": F.explode(F.sequence(west, east - 1, F.lit(step).cast("long")))})
    cells = wide.withColumn("s", F.explode(F.sequence(F.col("_south"), F.col("_north") - 1, F.lit(step).cast("long"))))
    cells = cells.withColumns({"e": F.least(F.col("w") + step, F.col("_east")), "n": F.least(F.col("s") + step, F.col("_north"))}).drop("_east", "_south", "_north")
    return cells.withColumn("name", F.format_string("slice_%d_%d_%d_%d.pbf", "w", "s", "e", "n"))


def slice_names(spark: SparkSession, box: tuple[int, int, int, int], step: int) -> DataFrame:
    """The grid cells of one box with their file names."""
    return slices_in(spark.range(1).select(), tuple(map(F.lit, box)), step)


def parsed_slice(name: Column) -> Column:
    """The four bounds in a slice's file name, as an array."""
    return F.transform(F.slice(F.split(F.regexp_replace(name, r"\.pbf$", ""), "_"), 2, 4), lambda x: x.cast("long"))


def tile_file(zoom: Column, x: Column, y: Column) -> Column:
    return F.format_string("%d_%d_%d.png", zoom, x, y)
