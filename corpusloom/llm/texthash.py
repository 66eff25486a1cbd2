"""Vectorised hashing of the words of a batch of texts.

A word's hash is a polynomial over its bytes modulo 2**64 with table values for bytes, computed from
one running sum over the batch; hashes of runs of words come from a running sum over words in the
same way.  Hashes are the same in every process and on every machine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MASK = (1 << 64) - 1
#: Odd multipliers: of bytes in a word and of words in a run, for two independent families.
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads differences over all bits."""
    x = x.astype(U64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> U64(30)
        x *= U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
    return x


def _byte_values(seed: int) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=U64) + U64(seed << 32))
    values[_SPACE] = 0
    return values


_BYTES = (_byte_values(1), _byte_values(2))


#: Tables of powers grow by so many entries, to stay about as long as the largest chunk.
GROWN_BY = 1 << 18


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, factor: int):
        self.factor, self.inverse = factor, pow(factor, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = -(-n // GROWN_BY) * GROWN_BY
            with np.errstate(over="ignore"):
                self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, U64), np.full(size - 1, f, U64)])) for f in (self.factor, self.inverse))
        return self.up[:n], self.down[:n]


_POWERS = [_Powers(f) for f in _FACTORS]


def _runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """The polynomial of ``values[starts:ends]`` for each pair."""
    up, down = powers.of(len(values) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, U64), np.cumsum(values * up[: len(values)], dtype=U64)])
        return mix((total[ends] - total[starts]) * down[starts])


class Words:
    """The words of some texts: byte ranges, hashes, and the range of words of each text."""

    def __init__(self, texts: pa.Array, second: bool = False):
        texts = texts.fill_null("").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = texts.buffers()[2] if len(texts) else None
        whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.bytes = whole[offsets[0] : offsets[-1]]
        bounds = offsets - offsets[0]
        self.text_bounds = bounds
        space = _SPACE[self.bytes]
        n = len(space)
        before, after = np.ones(n + 1, bool), np.ones(n + 1, bool)
        before[1:n] = space[: n - 1] if n else space
        before[bounds] = True
        after[: n - 1] = space[1:] if n else after[:0]
        after[bounds[1:] - 1] = True  # a text's last byte; for an empty text the byte before it, which ends a text too
        self.starts = np.flatnonzero(~space & before[:n])
        self.ends = np.flatnonzero(~space & after[:n]) + 1
        #: Words of text k: range(first[k], first[k + 1]).
        self.first = np.searchsorted(self.starts, bounds)
        self.counts = np.diff(self.first)
        self.hashes = [_runs(_BYTES[f][self.bytes], self.starts, self.ends, _POWERS[f]) for f in range(1 + second)]
        self.text_of = np.repeat(np.arange(len(texts)), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def runs(self, length: int, family: int = 0) -> np.ndarray:
        """The hash of the run of ``length`` words from each word on; of no meaning where it leaves the text."""
        n = len(self)
        at = np.arange(n)
        return _runs(self.hashes[family], at, np.minimum(at + length, n), _POWERS[2 + family])

    def whole(self, family: int = 0) -> np.ndarray:
        """The hash of all words of each text, with their number."""
        out = _runs(self.hashes[family], self.first[:-1], self.first[1:], _POWERS[2 + family])
        with np.errstate(over="ignore"):
            return mix(out + self.counts.astype(U64) * U64(_FACTORS[0]))

    def fits(self, length: int) -> np.ndarray:
        """Whether the run of ``length`` words from each word on stays in its text."""
        return np.arange(len(self)) + length <= self.first[1:][self.text_of]

    def text(self, k: int, keep: np.ndarray | None = None) -> bytes:
        """Words of text k joined by one space; ``keep`` selects among them."""
        words = self.bytes[self.text_bounds[k] : self.text_bounds[k + 1]].tobytes().split()
        return b" ".join(words if keep is None else [w for w, kept in zip(words, keep.tolist(), strict=True) if kept])
