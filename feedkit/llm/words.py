"""Words and word windows of a whole Arrow column at once, in numpy.

Texts stay in the column's own UTF-8 buffer; words are byte ranges of it, hashed with polynomials modulo a prime whose
prefix sums give any range in one subtraction. No Python object is made per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space that ends a word: space, and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

# What tells two hashes of a text apart; the multipliers of a hash are derived from it.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
PRIME = (1 << 31) - 1
_P, _31 = np.uint64(PRIME), np.uint64(31)
SHORT = 64
_SMALL = 1 << 23  # so many bytes times powers add up in 64 bits


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _fold(x: np.ndarray) -> np.ndarray:
    """A smaller number with the same remainder modulo ``PRIME``."""
    return (x & _P) + (x >> _31)


def _remainder(x: np.ndarray) -> np.ndarray:
    x = _fold(_fold(x))
    return np.where(x >= _P, x - _P, x)


@lru_cache(maxsize=12)
def _powers(multiplier: int, size: int) -> np.ndarray:
    out = np.ones(size, np.uint32)
    done = 1
    while done < size:
        step = np.uint64(pow(multiplier, done, PRIME))
        more = min(done, size - done)
        out[done : done + more] = _remainder(out[:more].astype(np.uint64) * step)
        done += more
    return out


@lru_cache(maxsize=3)
def _odd_powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _room(n: int) -> int:
    size = 1 << 19
    while size < n + 1:
        size *= 2
    return size


def powers(multiplier: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a multiplier and of its inverse modulo ``PRIME``, at least ``n + 1`` of them."""
    return _powers(multiplier, _room(n)), _powers(pow(multiplier, -1, PRIME), _room(n))


@lru_cache(maxsize=16)
def _multiplier(base: int, k: int) -> int:
    return int(mix(np.array([(base + k) & ((1 << 64) - 1)], np.uint64))[0]) % (PRIME - 3) + 2


def ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Mixed hash of ``values[start:end]`` for every pair.

    Ranges of more than ``SHORT`` values have two polynomials modulo a prime, 62 bits together. Shorter ones have one
    modulo 2**64, which is faster; for long ranges it would not do, as some pairs of them (Thue-Morse words) have one value
    whatever the multiplier, while at this length the worst of them still differ in 38 bits.
    """
    long = np.flatnonzero(ends - starts > SHORT)
    if len(long) and len(long) == len(starts):
        return _long(values, starts, ends, base)
    up, down = _odd_powers(base, _room(len(values)))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=total[1:])
    out = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    if len(long):
        out[long] = _long(values, starts[long], ends[long], base)
    return out


def _long(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    sizes = ends - starts
    if int(sizes.sum()) < len(values) // 2:  # only what the ranges hold
        upto = np.cumsum(sizes)
        values = values[np.arange(int(upto[-1])) + np.repeat(starts - (upto - sizes), sizes)]
        starts, ends = upto - sizes, upto
    halves = []
    for k in range(2):
        multiplier = _multiplier(base, k)
        up, down = powers(multiplier, len(values))
        if values.dtype == np.uint8:
            terms = (values.astype(np.uint64) + np.uint64(1)) * up[: len(values)]
        else:
            terms = (mix(values.astype(np.uint64) + np.uint64(multiplier)) >> np.uint64(33)) * up[: len(values)]
        if values.dtype != np.uint8 or len(values) > _SMALL:
            terms = _fold(terms)
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(terms, out=total[1:])
        halves.append(_remainder(_remainder(total[ends] - total[starts]) * down[starts]))
    return mix((halves[0] << _31 | halves[1]) + sizes.astype(np.uint64) * np.uint64(BASES[0]))


class Texts:
    """Words of a slice of documents: ``data`` bytes, ``starts``/``ends`` of the words in it, ``first`` word of each document."""

    def __init__(self, texts: pa.Array, space: np.ndarray = SPACE, lower: bool = False):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        lo, hi = texts.offset, texts.offset + len(texts) + 1
        self.bounds = np.frombuffer(offsets, np.int64)[lo:hi] if len(texts) else np.zeros(1, np.int64)
        base = int(self.bounds[0])
        self.bounds = self.bounds - base
        size = int(self.bounds[-1])
        self.data = np.frombuffer(data, np.uint8)[base : base + size] if size else np.zeros(0, np.uint8)
        if lower:  # A-Z only
            self.data = self.data + ((self.data >= 65) & (self.data <= 90)).astype(np.uint8) * np.uint8(32)
        inside = ~space[self.data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:]
        edges = self.bounds[1:-1]
        edges = edges[(edges > 0) & (edges < size)]
        begins[edges] |= inside[edges]
        stops[edges - 1] |= inside[edges - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        #: Index of each document's first word; one more entry than documents.
        self.first = np.searchsorted(self.starts, self.bounds)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Document index of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, base: int = BASES[0]) -> np.ndarray:
        return ranges(self.data, self.starts, self.ends, base)

    def windows(self, size: int, *bases: int) -> tuple[np.ndarray, ...]:
        """Word index of every window of ``size`` words inside one document, and one hash of it per base."""
        at = self.window_starts(size)
        out = [at]
        for base in bases or (BASES[0],):
            out.append(ranges(self.hashes(base), at, at + size, base ^ 0x5555555555555554))
        return tuple(out)

    def window_starts(self, size: int) -> np.ndarray:
        room = np.maximum(self.counts - size + 1, 0)
        before = np.cumsum(room) - room
        return np.arange(int(room.sum())) + np.repeat(self.first[:-1] - before, room)


def release() -> None:
    """Give free memory back to the machine: Python workers live on, and Arrow and the allocator hold on to what they had."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about ``most``; a larger item is a range of its own."""
    total = np.concatenate(([0], np.cumsum(sizes)))
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        yield at, to
        at = to


def text_slices(texts: pa.Array, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text each, so that working memory does not follow the batch size."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    return slices(sizes, most)


def column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    col = batch.column(name)
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
