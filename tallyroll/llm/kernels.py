"""Array code shared by the operators: words, rolling hashes, window minima, set bits.

Everything works on the UTF-8 bytes of an Arrow string column, without a Python object per word.
Hashes are 64-bit polynomial hashes over a fixed random table, mixed at the end.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
# White space of the contract: U+0020 and U+0009 to U+000D. No other byte of UTF-8 has these values.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# A fixed table, so that hashes agree between tasks and runs.
TABLE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = U64(0x9E3779B97F4A7C15)
SLICE_BYTES = 1 << 18


def give_back() -> None:
    """Return what this Python worker has freed to the system: workers are used again and else keep their peaks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        # Another C library; nothing to return by this way.
        return


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` on the batches of a task, giving back before and after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from work(batches)
        give_back()

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(base: int | np.uint64, n: int) -> np.ndarray:
    """base**0 to base**(n-1), modulo 2**64."""
    out = np.full(max(n, 1), U64(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def strings(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null is empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.string())
    array = pc.fill_null(array, "")
    wide = pa.types.is_large_string(array.type)
    _, offsets, data = array.buffers()
    n = len(array)
    if not n or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + n + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def runs(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes together, or one row."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        yield low, high
        low = high


@dataclass
class Words:
    """Words of rows ``low`` to ``high``: hash, row (from ``low``), first byte and end in the whole buffer."""

    low: int
    high: int
    hash: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def bounds(self) -> np.ndarray:
        """Position of the first word of each row, and the number of words."""
        return np.searchsorted(self.row, np.arange(self.high - self.low + 1))


def _word_spans(data: np.ndarray, edges: np.ndarray, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of solid bytes that don't cross an edge."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, solid[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, solid[1:]
    inner = edges[(edges > 0) & (edges < len(data))]
    before[inner] = False
    after[inner - 1] = False
    return np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1


def _hash_spans(data: np.ndarray, solid: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    first = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(first, length)
    values = TABLE[data[solid]] * powers(BASE, int(length.max()))[place]
    return mix(np.add.reduceat(values, first) ^ (length.astype(np.uint64) * U64(0xD6E8FEB86659FD93)))


def words(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES, space: np.ndarray = SPACE) -> Iterator[Words]:
    """The words of all rows, some rows at a time. A long row is cut at white space while it is read."""
    for low, high in runs(offsets, limit):
        parts, at, stop = [], int(offsets[low]), int(offsets[high])
        while at < stop:
            cut = stop
            if stop - at > 2 * limit:
                cut = at + limit
                while cut < stop and not space[data[cut]]:
                    gap = np.flatnonzero(space[data[cut : cut + 65536]])
                    cut = min(stop, cut + (int(gap[0]) if len(gap) else 65536))
            piece = data[at:cut]
            solid = ~space[piece]
            start, end = _word_spans(piece, offsets[low : high + 1] - at, solid)
            parts.append((_hash_spans(piece, solid, start, end), start + at, end + at))
            at = cut
        if parts:
            value, start, end = (np.concatenate(x) for x in zip(*parts, strict=True))
        else:
            value, start, end = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        row = np.searchsorted(offsets[low : high + 1], start, side="right") - 1
        yield Words(low, high, value, row, start, end)


def rolling(values: np.ndarray, n: int, base: int = 0xC2B2AE3D27D4EB4F) -> np.ndarray:
    """Rabin-Karp hashes of every n consecutive values (none if there are fewer)."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    # Doubling: the hash of 2m values is that of the first m times base**m plus that of the next m.
    total, width = None, 0
    block, size, factor = values, 1, U64(base)
    rest = n
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                if total is None:
                    total, width = block, size
                else:
                    m = len(values) - width - size + 1
                    total, width = total[:m] * factor + block[width : width + m], width + size
            rest >>= 1
            if rest:
                m = len(values) - 2 * size + 1
                block = block[:m] * factor + block[size : size + m]
                factor, size = factor * factor, 2 * size
    return mix(total)


def covered(starts: np.ndarray, length, n: int) -> np.ndarray:
    """Mask of n places: those within ``length`` of a start."""
    step = np.bincount(starts, minlength=n + 1) - np.bincount(np.minimum(starts + length, n), minlength=n + 1)
    return np.cumsum(step[:n]) > 0


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    if len(values) < width:
        return values[:0]
    out, size = values, 1
    while 2 * size <= width:
        out = np.minimum(out[: len(out) - size], out[size:])
        size *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - size : width - size + len(values) - width + 1])


def anchors(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing: place of the smallest key of each window, leftmost if equal.

    Returns the anchors and, of each, the first and last window that has it. Windows of equal
    content get their anchor at the same place within the window.
    """
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    step = 1 << 22
    total = len(keys) - width + 1
    for low in range(0, max(total, 0), step):
        part = keys[low : min(low + step, total) + width - 1]
        # The place in the low bits breaks ties to the left.
        tagged = (part & ~U64((1 << 23) - 1)) | np.arange(len(part), dtype=np.uint64)
        place = (window_minimum(tagged, width) & U64((1 << 23) - 1)).astype(np.int64) + low
        parts.append((place, np.arange(low, low + len(place))))
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    place = np.concatenate([p for p, _ in parts])
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.concatenate((first[1:] - 1, [len(place) - 1]))
    return place[first], first, last
