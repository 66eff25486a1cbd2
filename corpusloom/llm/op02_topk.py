"""Exact top-k search by inner product: norm-sorted, with rotated partial sums and residual bounds.

Vectors are compared as integers, ``floor(scale * x)``, so scores are exact.  They are rotated by
the right singular vectors of the whole table (from its second-moment matrix), which moves most of
their length into the first coordinates.  Candidates are stored by descending length, then by id, with
their number in that order, and taken in segments of it, each four times as far as the one before.  A query's bar
is its k-th best candidate so far, by score and id: a candidate is dropped as soon as the inner product of
the first coordinates plus the product of the residual lengths (Cauchy-Schwarz) stays below the bar's score;
survivors are scored in full, and pass only if they beat the bar, ties by the smaller id.  A query block is
done when the product of lengths alone bounds the next segment.

Queries go to executors in blocks of bounded size (``QUERY_BYTES``); each block reads the segments
it needs, which are ranges of the stored files.  A task keeps k candidates for each query of the block, so what is
shuffled is bounded by k times queries times the tasks of a segment, and mostly far less thanks to the bar.

Results for special rows: vectors that are null or hold null or non-finite components take no part,
neither do rows with a null id; shorter vectors count as padded with zeros; empty vectors score 0;
rows that share an id are never each other's candidates, are searched once, with the least of their
vectors, and are found as often as they are stored; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.runtime import checkpoint, release, ship, stored

SCALE, TOP = 64, 20
#: A block of queries, as broadcast to executors.
QUERY_BYTES = 32 << 20
#: Candidates in the first segment; each further one ends GROWTH times later.
FIRST_SEGMENT, GROWTH = 512, 4
#: Rows of candidates and of queries compared at once inside a task.
ROWS, QUERIES = 2048, 512
#: Share of the second moment that the first coordinates hold.
HEAD_SHARE = 0.6
#: Second moments are summed over so many groups of partitions, then over so many groups of those.
MOMENT_BUCKETS, MOMENT_ROWS = 1024, 32


def _matrix(column: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Integer vectors as rows of float64, padded, and which rows are usable."""
    lists = column.cast(pa.list_(pa.float64()))
    offsets = lists.offsets.to_numpy()
    flat = lists.values
    value = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    width = int(lengths.max(initial=0)) if dims is None else dims
    row = np.repeat(np.arange(len(lists)), lengths)
    inside = value[offsets[0] : offsets[-1]] if len(lists) else value[:0]
    usable = lists.is_valid().to_numpy(zero_copy_only=False)
    bad = row[~np.isfinite(inside)]
    usable[bad] = False
    out = np.zeros((len(lists), width))
    out[row, np.arange(len(row)) - (offsets[:-1] - offsets[0])[row]] = np.where(np.isfinite(inside), np.floor(SCALE * inside), 0)
    return out, usable


MOMENTS = "bucket int, dims int, n long, m binary"


def _moment_rows(bucket: int, n: int, total: np.ndarray) -> list[pa.Array]:
    return [pa.array([bucket], pa.int32()), pa.array([len(total)], pa.int32()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())]


def _added(total: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Sum of two square matrices, the smaller one padded with zeros."""
    if len(part) > len(total):
        total, part = part.copy(), total
    total[: len(part), : len(part)] += part
    return total


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The second moments of a partition."""
    total, n = np.zeros((0, 0)), 0
    for batch in batches:
        m, usable = _matrix(batch.column(1))
        m = m[usable]
        n += len(m)
        total = _added(total, m.T @ m)
    bucket = TaskContext.get().partitionId() % MOMENT_BUCKETS
    yield pa.RecordBatch.from_arrays(_moment_rows(bucket, n, total), ["bucket", "dims", "n", "m"])


def _moment_sum(table: pa.Table) -> pa.Table:
    total = np.zeros((0, 0))
    for dims, m in zip(table.column("dims").to_pylist(), table.column("m").to_pylist(), strict=True):
        total = _added(total, np.frombuffer(m).reshape(dims, dims).copy())
    arrays = _moment_rows(table.column("bucket")[0].as_py() % MOMENT_ROWS, sum(table.column("n").to_pylist()), total)
    return pa.Table.from_arrays(arrays, ["bucket", "dims", "n", "m"])


def second_moments(rows: DataFrame) -> tuple[np.ndarray, int]:
    """The second-moment matrix and the number of usable vectors; MOMENT_ROWS matrices reach the driver."""
    sums = rows.mapInArrow(_moments, MOMENTS)
    for _ in range(2):
        sums = sums.groupBy("bucket").applyInArrow(_moment_sum, MOMENTS)
    total, n = np.zeros((0, 0)), 0
    for row in sums.collect():
        total = _added(total, np.frombuffer(row["m"]).reshape(row["dims"], row["dims"]).copy())
        n += row["n"]
    return total, n


def _prepared(dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, usable = _matrix(batch.column(1), dims)
            ids = batch.column(0).filter(pa.array(usable))
            m = m[usable]
            vectors = pa.array([v.tobytes() for v in m.astype(np.int64)], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, pa.array((m * m).sum(1).astype(np.int64)), vectors], ["vec_id", "norm2", "v"])

    return run


def _rotation(moments: np.ndarray) -> tuple[np.ndarray, int]:
    """The right singular vectors, longest first, and how many coordinates hold HEAD_SHARE of the length."""
    values, vectors = np.linalg.eigh(moments)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    whole = values.sum()
    head = int(np.searchsorted(np.cumsum(values), HEAD_SHARE * whole)) + 1 if whole > 0 else 1
    return np.ascontiguousarray(vectors), min(max(head, 1), len(values))


class _Best:
    """The best ``top`` candidates of each query: score descending, then id ascending."""

    def __init__(self, bars: np.ndarray, bar_ids: np.ndarray, top: int):
        self.bars, self.bar_ids, self.top = bars.copy(), bar_ids.copy(), top
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def beaten(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Which candidates are before the k-th best of their queries."""
        bars = self.bars[query]
        return (scores > bars) | (scores == bars) & (ids < self.bar_ids[query])

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self.found.append((query, ids, scores))
        self.waiting += len(query)
        if self.waiting > 40 * self.top * len(self.bars) + 200_000:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        query, ids, scores = (np.concatenate(c) for c in zip(*self.found, strict=True))
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        first = np.searchsorted(query, query)
        rank = np.arange(len(query)) - first
        full = np.flatnonzero(rank == self.top - 1)
        full = full[self.beaten(query[full], ids[full], scores[full])]
        self.bars[query[full]], self.bar_ids[query[full]] = scores[full], ids[full]
        kept = rank < self.top
        self.found = [(query[kept], ids[kept], scores[kept])]
        self.waiting = int(kept.sum())
        return self.found[0]


def _searcher(block: object, top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, bars, bar_ids, rotation, head = block.value
        turned = queries @ rotation
        near, rest = turned[:, :head], np.linalg.norm(turned[:, head:], axis=1)
        best = _Best(bars, bar_ids, top)
        slack = 1e-9 * (1 + np.linalg.norm(queries, axis=1))
        for batch in batches:
            ids_all = batch.column(0).to_numpy()
            flat = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64).reshape(len(ids_all), -1)
            for start in range(0, len(ids_all), ROWS):
                ids, vectors = ids_all[start : start + ROWS], flat[start : start + ROWS].astype(np.float64)
                moved = vectors @ rotation
                length, tail = np.linalg.norm(vectors, axis=1), np.linalg.norm(moved[:, head:], axis=1)
                for low in range(0, len(query_ids), QUERIES):
                    part = slice(low, low + QUERIES)
                    bound = near[part] @ moved[:, :head].T + rest[part, None] * tail
                    maybe = bound + slack[part, None] * (1 + length) >= best.bars[part, None]
                    maybe &= query_ids[part, None] != ids
                    q, c = np.nonzero(maybe)
                    if not len(q):
                        continue
                    if len(q) * 4 > maybe.size:
                        scores = (queries[part] @ vectors.T)[q, c]
                    else:
                        scores = np.einsum("ij,ij->i", queries[part][q], vectors[c])
                    scores = np.rint(scores).astype(np.int64)
                    over = best.beaten(q + low, ids[c], scores)
                    best.add(q[over] + low, ids[c[over]], scores[over])
        query, ids, scores = best.cut()
        arrays = [pa.array(query_ids[query], pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    return run


def _segments(sorted_: DataFrame, n: int) -> list[int]:
    """Where segments end: the places of the rows of rank FIRST_SEGMENT, GROWTH times that, and so on."""
    sizes = sorted_.groupBy(F.shiftright("place", 33).alias("part")).count().orderBy("part").collect()
    before = np.concatenate([[0], np.cumsum([r["count"] for r in sizes])]).astype(np.int64)
    ends, rank = [], FIRST_SEGMENT
    while rank < n:
        k = int(np.searchsorted(before, rank, "right")) - 1
        ends.append((sizes[k]["part"] << 33) + rank - int(before[k]))
        rank *= GROWTH
    return ends


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def top_inner_products(vectors: DataFrame, is_query: Column, top: int = TOP, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` best other vectors of each vector for which ``is_query``
    (a condition on the column ``vec_id``) holds.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").alias("e")).filter("vec_id IS NOT NULL")
    moments, n = second_moments(rows)
    dims = max(1, len(moments))
    rotation, head = _rotation(moments) if len(moments) else (np.eye(1), 1)
    ready = rows.mapInArrow(_prepared(dims), "vec_id long, norm2 long, v binary")
    longest = [F.col("norm2").desc(), F.col("vec_id")]
    # The last key parts rows that share length and id.
    ranged = ready.repartitionByRange(*longest, F.rand(1)).sortWithinPartitions(*longest)
    sorted_ = stored(ranged.withColumn("place", F.monotonically_increasing_id()))
    release(spark)
    ends = _segments(sorted_, n)
    norms = {r["place"]: r["norm2"] for r in sorted_.filter(F.col("place").isin(ends)).select("place", "norm2").collect()} if ends else {}
    queries = sorted_.filter(is_query)
    total = queries.count()
    per_block = max(1, QUERY_BYTES // (8 * dims))
    blocks = -(-total // per_block)
    results = []
    for b in range(blocks):
        own = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).select("vec_id", "v").collect()
        if not own:
            continue
        ids = np.array([r["vec_id"] for r in own], np.int64)
        matrix = np.frombuffer(b"".join(bytes(r["v"]) for r in own), np.int64).reshape(len(own), -1)
        order = np.lexsort((*matrix.T[::-1], ids))
        ids, once = np.unique(ids[order], return_index=True)
        matrix = matrix[order][once].astype(np.float64)
        bars, bar_ids = np.full(len(ids), np.iinfo(np.int64).min // 2, np.int64), np.full(len(ids), np.iinfo(np.int64).max, np.int64)
        best, start = None, None
        for end in [*ends, None]:
            if start is not None and (np.linalg.norm(matrix, axis=1) * np.sqrt(norms[start]) + 1 < bars).all():
                break
            segment = sorted_ if start is None else sorted_.filter(F.col("place") >= start)
            segment = segment if end is None else segment.filter(F.col("place") < end)
            block = spark.sparkContext.broadcast((ids, matrix, bars, bar_ids, rotation, head))
            found = segment.select("vec_id", "norm2", "v").mapInArrow(_searcher(block, top), "query_id long, vec_id long, score long")
            best = checkpoint(_ranked(found if best is None else found.unionByName(best.drop("rank")), top))
            for row in best.filter(F.col("rank") == top).select("query_id", "vec_id", "score").collect():
                at = np.searchsorted(ids, row["query_id"])
                bars[at], bar_ids[at] = row["score"], row["vec_id"]
            start = end
        results.append(best)
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
