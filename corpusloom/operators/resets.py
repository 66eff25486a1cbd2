"""Running sums that start again at a limit, for groups of any size: shards by bytes, chunks under a cap.

Where a shard ends depends on where it began, so a plain fold reads a group from its first row to its last.
Here rows are dealt by ranges of group and order and sorted.  Inside a range, a row that opens a shard leads to the
one that opens the next, found in the prefix sums; following these steps from the last row to the first gives, for
each row as an opening, how many openings follow in the range and what the open shard then holds.  So a
range is a function from what the open shard holds on entry to what it holds on exit: a step for each row that
can be the first to open, all within one limit's worth of sizes.  These functions compose.  Only groups that
cross a border of ranges need them, of which there are fewer than ranges; their pieces are taken in order by one task a
group, a row for each piece, and with its entry known every range numbers its own rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.runtime import checkpoint, ship

#: A shard ends with the row that brings it to the limit, or before the row that would bring it over.
REACHING, BEFORE = "reaching", "before"


def _next_openings(sums: np.ndarray, from_sum: np.ndarray, limit: int, rule: str) -> np.ndarray:
    """For shards that held nothing at prefix sum ``from_sum``, the index of the row that opens the next; beyond the end there is none.

    A shard that is closed by the last row gives the length, one that stays open gives the length plus one.
    """
    n = len(sums)
    if rule == REACHING:
        return np.searchsorted(sums, from_sum + limit, "left") + 1
    first = np.searchsorted(sums, from_sum + limit, "right")
    before = np.concatenate([[0], sums])[first]
    # A row over the limit stays where nothing is held yet; the row behind it opens.
    found = np.where(before > from_sum, first, first + 1)
    return np.where(found >= n, n + 1, found)


def openings(sizes: np.ndarray, held: int, limit: int, rule: str) -> list[int]:
    """The rows of a piece that open a shard, given what the open one holds on entry; the length where the next row does."""
    sums = np.cumsum(sizes, dtype=np.int64)
    n, out, base = len(sums), [], -held
    while True:
        at = int(_next_openings(sums, np.int64(base), limit, rule))
        if at > n:
            return out
        out.append(at)
        if at == n:
            return out
        base = int(sums[at - 1]) if at else 0


def exit_state(sizes: np.ndarray, held: int, limit: int, rule: str) -> tuple[int, int]:
    """Openings in a piece, and what the open shard holds at its end."""
    found = openings(sizes, held, limit, rule)
    return len(found), int(sizes.sum()) + held if not found else int(sizes[found[-1] :].sum())


def transfer(sizes: np.ndarray, limit: int, rule: str) -> tuple[list[int], list[int], list[int]]:
    """The function of a piece: prefix sums of the rows that can be the first to open, with openings and exit state from there.

    ``apply_transfer`` evaluates it.  The last entries are those of no opening.
    """
    sums = np.cumsum(sizes, dtype=np.int64)
    n, total = len(sums), int(sums[-1])
    begins = np.concatenate([[0], sums[:-1]])
    after = _next_openings(sums, begins, limit, rule)
    count, left = np.zeros(n + 2, np.int64), np.zeros(n + 2, np.int64)
    for i in range(n - 1, -1, -1):
        at = after[i]
        if at > n:
            count[i], left[i] = 0, total - begins[i]
        else:
            count[i], left[i] = count[at] + 1, left[at]
    # An entry holds nothing to a limit, so the first opening lies within the rows of one limit.
    reach = min(n, int(np.searchsorted(sums, limit, "right")) + 2)
    return sums[:reach].tolist(), (count[: reach + 1] + 1).tolist(), left[: reach + 1].tolist()


def apply_transfer(function: tuple[list[int], list[int], list[int]], total: int, n: int, held: int, limit: int, rule: str) -> tuple[int, int]:
    """Openings and exit state of a piece of ``n`` rows of ``total`` size for an entry state."""
    sums, count, left = function
    at = int(_next_openings(np.array(sums, np.int64), np.int64(-held), limit, rule))
    if at > len(sums):
        return 0, held + total
    return (1, 0) if at == n else (count[at], left[at])


Key = tuple[Any, ...]


def _pieces(batches: Iterator[pa.RecordBatch], keys: list[int]) -> Iterator[tuple[Key, pa.Table]]:
    """The rows of each group in a task, which come sorted."""
    key, held = None, []
    for batch in batches:
        found = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        starts = [k for k in range(len(found)) if k == 0 or found[k] != found[k - 1]]
        for start, end in zip(starts, [*starts[1:], len(found)], strict=True):
            if held and found[start] != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = found[start]
            held.append(batch.slice(start, end - start))
    if held:
        yield key, pa.Table.from_batches(held)


def _sizes(rows: pa.Table, size: str) -> np.ndarray:
    return rows.column(size).fill_null(0).to_numpy().astype(np.int64)


def reset_sums(rows: DataFrame, group: list[str], order: list[str], size: str, limit: int, rule: str = REACHING, name: str = "shard") -> DataFrame:
    """``rows`` with the number of each one's shard in its group, from 0, along ``order``.

    Sizes are not negative, a null one is 0; groups may be null; rows equal in ``order`` stand in any order.
    """
    if rule not in (REACHING, BEFORE):
        raise ValueError(f"unknown rule {rule!r}")
    ship(rows.sparkSession)
    sorted_rows = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    parts = checkpoint(sorted_rows).withColumn("_part", F.spark_partition_id())
    columns = parts.columns
    keys, part_at = [columns.index(g) for g in group], columns.index("_part")
    entries = _entries(parts, group, size, limit, rule)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, piece in _pieces(batches, keys):
            held, shard = entries.get((*key, piece.column(part_at)[0].as_py()), (0, 0))
            sizes = _sizes(piece, size)
            opens = np.zeros(len(sizes) + 1, np.int64)
            opens[openings(sizes, held, limit, rule)] = 1
            numbered = piece.drop_columns(["_part"]).append_column(name, pa.array(shard + np.cumsum(opens[:-1]), pa.int64()))
            yield from numbered.to_batches()

    return parts.mapInArrow(number, T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())]))


def _entries(parts: DataFrame, group: list[str], size: str, limit: int, rule: str) -> dict[Key, tuple[int, int]]:
    """What the open shard holds, and its number, on entry to the pieces that continue a group: one for a range at most."""
    spans = parts.groupBy(*group).agg(F.min("_part").alias("_first"), F.max("_part").alias("_last")).filter("_first < _last")
    same = F.lit(True)
    for g in group:
        same = same & F.col(f"p.{g}").eqNullSafe(F.col(f"s.{g}"))
    cut = parts.alias("p").join(F.broadcast(spans).alias("s"), same, "left_semi").select(*(f"p.{g}" for g in group), "p._part", f"p.{size}")
    kinds = [parts.schema[g] for g in group]
    keys = list(range(len(group)))
    functions = T.StructType([*kinds, *T._parse_datatype_string("_part int, n long, total long, sums array<long>, openings array<long>, held array<long>").fields])
    columns = [f.name for f in functions]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, piece in _pieces(batches, keys):
            sizes = _sizes(piece, size)
            key = [piece.column(k).slice(0, 1).combine_chunks() for k in keys]
            longs = [pa.array([v], pa.int64()) for v in (len(sizes), int(sizes.sum()))]
            lists = [pa.array([v], pa.list_(pa.int64())) for v in transfer(sizes, limit, rule)]
            yield pa.RecordBatch.from_arrays([*key, piece.column("_part").slice(0, 1).combine_chunks(), *longs, *lists], columns)

    made = cut.mapInArrow(run, functions)
    entry = T.StructType([*kinds, *T._parse_datatype_string("_part int, held long, shard long").fields])
    chain = partial(_chained, n_keys=len(group), limit=limit, rule=rule, names=[f.name for f in entry])
    found = made.repartition(*group).sortWithinPartitions(*group, "_part").mapInArrow(chain, entry)
    return {tuple(r[:-2]): (r["held"], r["shard"]) for r in found.collect()}


def _chained(batches: Iterator[pa.RecordBatch], n_keys: int, limit: int, rule: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The state on entry to each piece, from piece to piece of a group."""
    key, held, shard = None, 0, 0
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            own, (part, n, total, *function) = tuple(c[0].as_py() for c in row.columns[:n_keys]), (c[0].as_py() for c in row.columns[n_keys:])
            if own != key:
                key, held, shard = own, 0, 0
            yield pa.RecordBatch.from_arrays([*row.columns[: n_keys + 1], pa.array([held], pa.int64()), pa.array([shard], pa.int64())], names)
            opened, held = apply_transfer(tuple(function), total, n, held, limit, rule)
            shard += opened
