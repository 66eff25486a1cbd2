"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words; each of its documents is expected in ``target / size of
the source`` copies.  Documents of a source stand in one fixed order (by length class, then by a
digest of the id, then by id); the expected copies are summed along it from one random offset, and
a document is emitted once for each integer that its step crosses.  Equal steps over an order by
length spread the sample over short and long documents alike, so the words taken stay near the
target.

The order is cut into cells (length class and first digits of the digest, as many as keep a cell to about
``CELL_ROWS`` documents).  A cell's number of documents before it comes from sums over cells; only inside a
cell are rows numbered.  No source is gathered in one task, however large, and texts are read once and
never shuffled.  Sources may be many, too: their order and their sums are made from ranges.

Results for special rows: a null text has size 0 and, like every text without words, takes 0 words
in as many copies as its source's rate says; a null source comes last in the order of weights;
repeated rows are documents of their own; an empty table gives an empty result; further columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import word_count
from corpusloom.runtime import checkpoint

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = "mix-1"
#: Documents of a cell, about; a cell is numbered in one task.
CELL_ROWS = 100_000


def _with_sums_before(rows: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """``rows`` with, under each name, the sum of an expression over the rows before in ``order``.

    Sums inside ranges are added to those of the ranges before; no task gets more than a range.
    """
    parts = checkpoint(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    whole = parts.groupBy("_part").agg(*(F.expr(f"sum({e}) AS _all_{n}") for n, e in sums.items()))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = whole.select("_part", *(F.coalesce(F.sum(f"_all_{n}").over(earlier), F.lit(0)).alias(f"_ahead_{n}") for n in sums))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = parts.withColumns({n: F.coalesce(F.sum(F.expr(e)).over(inside), F.lit(0)) for n, e in sums.items()})
    found = found.join(F.broadcast(ahead), "_part")
    return found.withColumns({n: F.col(n) + F.col(f"_ahead_{n}") for n in sums}).select(*rows.columns, *sums)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Source, its size, its target and its expected copies, from a table (source, source_size).

    The rows are sources, one each.  Targets are ``least(most * size, level * weight)``; the level
    that spends the whole is found by filling sources in the order in which they saturate.
    """
    named = _with_sums_before(sizes, [F.col("source").asc_nulls_last()], {"place": "1"})
    cycle = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    rows = named.select("source", "source_size", cycle.cast("long").alias("weight"), (most * F.col("source_size")).alias("cap"))
    filling = [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()]
    rows = checkpoint(_with_sums_before(rows, filling, {"full": "cap", "used": "weight"}))
    weight, whole = (x or 0 for x in rows.agg(F.sum("weight"), F.sum("source_size")).first())
    rows = rows.withColumn("level", (F.lit(whole) - F.col("full")).cast("double") / (F.lit(weight) - F.col("used")))
    # The level rises while the next source saturates below it and falls after: its peak spends the whole.
    peak = rows.agg(F.max("level")).first()[0] or 0.0
    target = F.least(F.col("cap").cast("double"), F.lit(peak) * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return rows.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def length_class(size: Column) -> Column:
    """A string that sorts as ``size`` does, equal for sizes that differ by less than an eighth."""
    bits = F.bin(size)
    return F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.rpad(F.substring(bits, 1, 4), 4, "0"))


def _digest(value: Column) -> Column:
    return F.md5(value.cast("binary"))


def offset(seed: str = SEED) -> Column:
    """A number in [0, 1) fixed by the source and the seed."""
    text = F.concat(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("~")), F.lit(seed))
    return F.conv(F.substring(_digest(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def copies_of(sizes: DataFrame, keys: list[str], weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """``sizes`` with source_size, target and ``copies``.

    ``sizes`` needs ``doc_id``, ``source`` and ``size``; it is read three times and should be a
    checkpointed table.  ``keys`` names its columns to carry.
    """
    cell = ["src", "class", "digits"]
    rows = sizes.withColumns(
        {
            "src": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("~")),
            "class": length_class(F.col("size")),
            "digest": _digest(F.coalesce(F.col("doc_id").cast("string"), F.lit("~"))),
        }
    )
    largest = rows.groupBy("src", "class").count().agg(F.max("count")).first()[0] or 0
    digits = next(d for d in range(1, 33) if CELL_ROWS * 16**d >= largest)
    rows = rows.withColumn("digits", F.substring("digest", 1, digits))
    cells = checkpoint(rows.groupBy("source", *cell).agg(F.count("*").alias("n"), F.sum("size").alias("words")))
    sources = cells.groupBy("source", "src").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sources.select("source", "source_size"), weights, most)
    before = Window.partitionBy("src").orderBy("class", "digits").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
    starts = starts.alias("c").join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source")))
    starts = starts.select(*(F.col(f"c.{k}").alias(k) for k in cell), "ahead", "t.source_size", "t.target", "t.rate")
    starts = checkpoint(starts)
    inside = Window.partitionBy(*cell).orderBy("digest", F.col("doc_id").asc_nulls_last(), "size")
    ranked = rows.withColumn("rn", F.row_number().over(inside)).join(starts, cell)
    rank = F.col("ahead") + F.col("rn")
    upto = lambda n: F.floor(F.col("rate") * n + offset(seed))
    return ranked.withColumn("copies", (upto(rank) - upto(rank - 1)).cast("long")).select(*keys, "source_size", "target", "copies")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """For each document its size, its source's size and target, its copies and the words they hold."""
    sizes = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    out = copies_of(checkpoint(sizes), ["doc_id", "size"])
    return out.withColumn("taken", F.col("copies") * F.col("size"))
