"""Text columns as numpy arrays inside a task: bytes, tokens and hashes of byte ranges.

Everything here works on one Arrow batch. Memory grows with the batch, or with the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE, WORD, MARK = 0, 1, 2

#: Class of each byte: ASCII white space and controls, letters and digits (all of non-ASCII too), other signs.
KIND = np.full(256, MARK, np.uint8)
KIND[:33] = SPACE
KIND[127] = SPACE
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    KIND[ord(_first) : ord(_last) + 1] = WORD
KIND[128:] = WORD

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept between calls."""
    if len(_powers[base]) < n:
        grown = np.full(max(n, 1 << 20), base, np.uint64)
        grown[0] = 1
        _powers[base] = np.cumprod(grown)
    return _powers[base][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, made longer until no column has it, whatever its case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


class Hashes:
    """64-bit hashes of any byte ranges of one buffer, from one running sum."""

    def __init__(self, data: np.ndarray):
        self._sum = np.zeros(len(data) + 1, np.uint64)
        # In place, as each array here is eight times the text.
        own = self._sum[1:]
        np.add(data, np.uint64(1), out=own, dtype=np.uint64)
        own *= _power(_BASE, len(data))
        np.cumsum(own, out=own)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        down = _power(_INVERSE, len(self._sum))
        return mix((self._sum[end] - self._sum[start]) * down[start])

    def rolling(self, width: int) -> np.ndarray:
        """The hash of the ``width`` bytes from each place on."""
        n = max(0, len(self._sum) - width)
        if not n:
            return np.zeros(0, np.uint64)
        h = self._sum[width:] - self._sum[:n]
        h *= _power(_INVERSE, n)
        return mix(h)


def slices(column: pa.Array, limit: int = 1 << 21) -> Iterator[tuple[int, pa.Array]]:
    """Runs of rows of at most ``limit`` bytes, or of a single longer text, each with its first row number."""
    column = column.cast(pa.large_string())
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    end = np.cumsum(size)
    start = 0
    while start < len(column):
        before = end[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(end, before + limit, "right")))
        yield start, column.slice(start, stop - start)
        start = stop


def joined(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, one after the other, and where each begins (and the last ends). Null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if lower:
        column = pc.utf8_lower(column)
    _, places, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and kind of each longest run of one kind of byte other than SPACE, within single texts."""
    kind = KIND[data]
    edge = np.ones(len(data) + 1, bool)
    if len(data):
        edge[1:-1] = kind[1:] != kind[:-1]
    edge[off] = True
    cut = np.flatnonzero(edge)
    start, end = cut[:-1], cut[1:]
    keep = kind[start] != SPACE if len(start) else np.zeros(0, bool)
    return start[keep], end[keep], kind[start[keep]]


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, .. for length[0] places, then the same for the next range."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(start.astype(np.int64) - first, length)


#: Fixed values of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(0x9E3779B185EBCA87),
    np.uint64(0xC2B2AE3D27D4EB4F),
    np.uint64(0x165667B19E3779F9),
    np.uint64(0x85EBCA77C2B2AE63),
    np.uint64(0x27D4EB2F165667C5),
)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of byte ranges of ``data``: ranges under 32 bytes all at once, longer ones one by one."""
    import xxhash

    size = end - start
    padded = np.zeros(len(data) + 32, np.uint8)
    padded[: len(data)] = data
    by8 = np.ndarray((len(padded) - 8,), "<u8", padded, strides=(1,))
    by4 = np.ndarray((len(padded) - 4,), "<u4", padded, strides=(1,))
    h = size.astype(np.uint64) + np.uint64(seed) + _P5
    for lane in range(3):
        at = np.flatnonzero((size >= 8 * lane + 8) & (size < 32))
        h[at] = _turn(h[at] ^ (_turn(by8[start[at] + 8 * lane] * _P2, 31) * _P1), 27) * _P1 + _P4
    done = size // 8 * 8
    at = np.flatnonzero((size - done >= 4) & (size < 32))
    h[at] = _turn(h[at] ^ (by4[start[at] + done[at]].astype(np.uint64) * _P1), 23) * _P2 + _P3
    done[at] += 4
    for byte in range(3):
        at = np.flatnonzero((size - done > byte) & (size < 32))
        h[at] = _turn(h[at] ^ (padded[start[at] + done[at] + byte].astype(np.uint64) * _P5), 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    h ^= h >> np.uint64(32)
    view = memoryview(padded)
    for i in np.flatnonzero(size >= 32).tolist():
        h[i] = xxhash.xxh64_intdigest(view[start[i] : end[i]], seed)
    return h
