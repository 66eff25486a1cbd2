"""Exact seeded samples without a sort of the table or a limit over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ordinals import dense_ids

#: Hexadecimal digits by which a round narrows the place of the last drawn row, and digits of a draw.
STEP, DIGITS = 3, 32
#: Rows of one cell that are ranked rather than narrowed further.
CELL_ROWS = 100_000


def exact_sample(df: DataFrame, draw: Column, order: list[str], n: int | None = None, ratio: float | None = None) -> DataFrame:
    """The ``n`` rows (or ``int(rows * ratio)``) with the least draws, ties along ``order``.

    ``draw`` is a digest of 32 hexadecimal digits, so it falls into cells evenly: counts by its first digits tell the
    cell in which the sample ends.  Cells before it are taken whole, those behind it not at all, and its
    own rows are ranked by ranges (``dense_ids``), so that one draw that many rows share is no single task's.
    """
    if (n is None) == (ratio is None):
        raise ValueError("give a number or a ratio")
    rows = df.withColumn("_draw", draw)
    prefix, before, cell_rows = "", 0, None
    while cell_rows is None or cell_rows > CELL_ROWS and len(prefix) < DIGITS:
        width = min(len(prefix) + STEP, DIGITS)
        inside = rows.filter(F.col("_draw").startswith(prefix)) if prefix else rows
        counts = sorted((r["cell"], r["n"]) for r in inside.groupBy(F.substring("_draw", 1, width).alias("cell")).agg(F.count("*").alias("n")).collect())
        if n is None:
            n = int(sum(c for _, c in counts) * ratio)
        for cell, count in counts:
            if before + count > n:
                prefix, cell_rows = cell, count
                break
            before += count
        else:
            return rows.drop("_draw")
    whole = rows.filter(F.col("_draw") < prefix)
    ending = rows.filter(F.col("_draw").startswith(prefix)).withColumns({"_all": F.lit(0), "_salt": F.monotonically_increasing_id()})
    ranked = dense_ids(ending, ["_all"], ["_draw", *order, "_salt"], "_rank")
    return whole.unionByName(ranked.filter(F.col("_rank") < n - before).drop("_all", "_salt", "_rank")).drop("_draw")
