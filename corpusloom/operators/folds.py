"""Order-dependent folds that no window expresses: gates over frames, shards by bytes."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.operators.resets import BEFORE, REACHING, reset_sums

#: The cap on image bytes of one written chunk (fixed value).
CHUNK_BYTES = 1_500_000_000


class NearIndex:
    """Hashes of 64 bits, asked whether one of them differs from a given one at fewer than ``below`` places.

    The bits are cut into ``below`` slices.  Two hashes that differ at fewer places than there are slices agree on
    one of these, so only hashes that share a slice are compared; equal hashes are kept once.
    """

    def __init__(self, below: int):
        self.below = below
        self.cuts = [(64 * k // below, 64 * (k + 1) // below) for k in range(min(below, 64))]
        self.slices: list[dict[int, list[int]]] = [defaultdict(list) for _ in self.cuts]
        self.held: set[int] = set()
        self.compared = 0

    def _parts(self, h: int) -> Iterator[tuple[dict[int, list[int]], int]]:
        for own, (a, b) in zip(self.slices, self.cuts, strict=True):
            yield own, (h >> a) & ((1 << (b - a)) - 1)

    def near(self, h: int) -> bool:
        if self.below <= 0 or not self.held:
            return False
        if self.below > 64 or h in self.held:  # any two differ at 64 places at most
            return True
        for own, part in self._parts(h):
            for other in own.get(part, ()):
                self.compared += 1
                if (h ^ other).bit_count() < self.below:
                    return True
        return False

    def add(self, h: int) -> None:
        if h not in self.held:
            self.held.add(h)
            for own, part in self._parts(h):
                own[part].append(h)


def gate_frames(
    frames: DataFrame, video: str, index: str, sample_rate: int | None = None, sharp: str | None = None, bits: str | None = None, tolerance: int = 0
) -> DataFrame:
    """The frames of each video that pass, in order, stride, sharpness and near-duplicate gates.

    A frame is looked at only if it lies more than ``sample_rate`` after the last kept one; its
    ``sharp`` flag must hold; its ``bits`` (a string of at most 64 zeros and ones) must differ in at least
    ``tolerance`` places from every kept frame's.  The gates share their state, so they run in one
    pass over a video's sorted rows, which carry hashes and flags and no pixels; a task holds an index of the
    hashes of one video's kept frames (``NearIndex``), and its rows batch by batch.
    """
    at = {c: k for k, c in enumerate(frames.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, last, kept = object(), None, NearIndex(tolerance)
        for batch in batches:
            n = batch.num_rows
            flags = batch.column(at[sharp]).to_pylist() if sharp else [True] * n
            hashes = [int(b, 2) for b in batch.column(at[bits]).to_pylist()] if bits else [0] * n
            keep = []
            for name, i, flag, h in zip(batch.column(at[video]).to_pylist(), batch.column(at[index]).to_pylist(), flags, hashes, strict=True):
                if name != current:
                    current, last, kept = name, None, NearIndex(tolerance)
                ok = bool(flag) and not (sample_rate is not None and last is not None and last + sample_rate >= i)
                if ok and bits:
                    ok = not kept.near(h)
                if ok:
                    last = i
                    if bits:
                        kept.add(h)
                keep.append(ok)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return frames.repartition(video).sortWithinPartitions(video, index).mapInArrow(run, frames.schema)


def byte_shards(chunks: DataFrame, dataset: str, order: str, size: str, target: int) -> DataFrame:
    """``chunks`` with ``shard``: a shard ends with the chunk that brings it to ``target``."""
    return reset_sums(chunks, [dataset], [order], size, target, REACHING, "shard")


def capped_chunks(samples: DataFrame, batch: list[str], order: str, size: str, cap: int = CHUNK_BYTES, name: str = "chunk") -> DataFrame:
    """``samples`` with the chunk of each in its batch: a sample that would bring a chunk over ``cap`` opens the next."""
    return reset_sums(samples, batch, [order], size, cap, BEFORE, name)
