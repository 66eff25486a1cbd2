"""Perceptual hashes and distances over small grids held in arrays."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import ship


def average_bits(grid: Column) -> Column:
    """A string of 0 and 1: whether each value lies above the mean."""
    mean = F.aggregate(grid, F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(grid)
    return F.array_join(F.transform(grid, lambda x: F.when(x.cast("double") > mean, "1").otherwise("0")), "")


def difference_bits(grid: Column, width: int = 8) -> Column:
    """A string of 0 and 1: whether each value lies below its right neighbour, row by row."""
    cells = F.sequence(F.lit(0), F.size(grid) - 1)
    inner = F.filter(cells, lambda i: i % width != width - 1)
    return F.array_join(F.transform(inner, lambda i: F.when(F.get(grid, i + 1) > F.get(grid, i), "1").otherwise("0")), "")


def hamming(a: Column, b: Column) -> Column:
    """The number of places at which two bit strings differ."""
    pairs = F.arrays_zip(F.split(a, "").alias("x"), F.split(b, "").alias("y"))
    return F.size(F.filter(pairs, lambda p: p["x"] != p["y"])).cast("long")


def _packed(bits: Column) -> Column:
    """A string of at most 63 zeros and ones as a number."""
    return F.conv(bits, 2, 10).cast("long")


#: Rows of a label are compared in blocks of about so many by as many, and so many of a block at once.
BLOCK_ROWS, STRIPE_ROWS = 4096, 256


def _compared(table: pa.Table, below: int) -> pa.Table:
    """For each row of two blocks of a label (or of one) the others it is near to: their number, the least distance and the first of those."""
    own, keys = table.column("own").to_numpy(), table.column("key").to_numpy()
    bits = table.column("bits").to_numpy().astype(np.uint64)
    low, high = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    count, least, nearest = np.zeros(len(keys), np.int64), np.full(len(keys), 65), np.zeros(len(keys), np.int64)
    for mine, others in ((low, high), (high, low))[: 1 if low == high else 2]:
        rows, columns = np.flatnonzero(own == mine), np.flatnonzero(own == others)
        columns = columns[np.argsort(keys[columns], kind="stable")]
        for start in range(0, len(rows), STRIPE_ROWS):
            stripe = rows[start : start + STRIPE_ROWS]
            if not len(columns):
                continue
            distance = np.bitwise_count(bits[stripe][:, None] ^ bits[columns][None, :]).astype(np.int64)
            distance[stripe[:, None] == columns[None, :]] = 65
            count[stripe] = (distance < below).sum(axis=1)
            at = distance.argmin(axis=1)
            least[stripe], nearest[stripe] = distance[np.arange(len(stripe)), at], keys[columns[at]]
    found = np.flatnonzero(count)
    return pa.table({"key": keys[found], "n": count[found], "distance": least[found], "nearest": nearest[found]})


def _dealt(named: DataFrame) -> DataFrame:
    """The rows of ``named`` (label, key, bits) without nulls, each with its block (``own``) of the ``blocks`` of its label."""
    sound = named.filter("label IS NOT NULL AND key IS NOT NULL AND bits IS NOT NULL")
    blocks = sound.groupBy("label").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    return sound.join(blocks, "label").withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))


def near_pairs(rows: DataFrame, label: str, key: str, bits: str, below: int) -> DataFrame:
    """Pairs (a, b, distance) of a label's rows, a < b, whose strings of at most 63 bits differ at fewer than ``below`` places.

    All pairs of a label are compared, in tasks of one block by one block, however large the label, and every near one is returned.
    """
    dealt = _dealt(rows.select(F.col(label).alias("label"), F.col(key).alias("key"), _packed(F.col(bits)).alias("bits")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    x = dealt.select("label", F.col("key").alias("a"), F.col("bits").alias("x"), F.col("own").alias("i"), other.alias("j"))
    y = dealt.select("label", F.col("key").alias("b"), F.col("bits").alias("y"), F.col("own").alias("j"), other.alias("i"))
    met = x.hint("shuffle_hash").join(y, ["label", "i", "j"]).filter("a < b")
    distance = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))).cast("long")
    return met.select("a", "b", distance.alias("distance")).filter(F.col("distance") < below)


def near_counts(rows: DataFrame, label: str, key: str, bits: str, below: int) -> DataFrame:
    """For each row its key, how many other rows of its label differ at fewer than ``below`` places (of at most 63), the least distance, and the first key at it.

    All rows of a label are compared, in tasks of one block by one block, which give a row for each of theirs and
    no pairs.  Rows with a null label, key or string are near to nothing; keys are numbers.
    """
    ship(rows.sparkSession)
    named = rows.select(F.col(label).alias("label"), F.col(key).cast("long").alias("key"), _packed(F.col(bits)).alias("bits"))
    dealt = _dealt(named)
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("label", "key", "bits", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    parts = met.groupBy("label", "i", "j").applyInArrow(lambda t: _compared(t, below), "key long, n long, distance long, nearest long")
    first = F.min(F.struct("distance", "nearest"))
    whole = parts.groupBy("key").agg(F.sum("n").alias("n_near"), first.alias("first"))
    out = named.select("key").join(whole, "key", "left")
    return out.select("key", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "first.distance", "first.nearest")


def bits_to_hex(bits: np.ndarray) -> str:
    """The hexadecimal form of a flat array of bits, the first the most significant."""
    return np.packbits(bits.astype(np.uint8).ravel()).tobytes().hex()


def _cosines(n: int) -> np.ndarray:
    k = np.arange(n)
    return 2 * np.cos(math.pi * k[:, None] * (2 * k[None, :] + 1) / (2 * n))


def phash(gray: np.ndarray, size: int = 8) -> str:
    """Of a 32 x 32 gray image: low frequencies of its cosine transform against their median."""
    c = _cosines(len(gray))
    low = (c @ gray.astype(float) @ c.T)[:size, :size]
    return bits_to_hex(low > np.median(low))


def dhash(gray: np.ndarray) -> str:
    """Of an image of 8 rows of 9: whether values rise to the right."""
    return bits_to_hex(gray[:, 1:] > gray[:, :-1])


def ahash(gray: np.ndarray) -> str:
    """Of an 8 x 8 image: whether values lie above the mean."""
    return bits_to_hex(gray > gray.mean())


def hex_distance(a: str, b: str) -> int:
    return (int(a, 16) ^ int(b, 16)).bit_count()
