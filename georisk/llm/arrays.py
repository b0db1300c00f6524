"""Texts of an Arrow batch as byte arrays: words, spans, hashes and shingles.

A word is a run of bytes other than space and the control characters 9 to 13;
in UTF-8 that is the pattern ``[^\\x20\\x09-\\x0D]+``. Nulls count as empty
texts. All functions are vectorised over a slice of documents, so the memory of
a task is bounded by ``SLICE_BYTES`` or by its longest single document.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_TABLE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_FOLD = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, size: int) -> np.ndarray:
    out = np.ones(size, dtype=np.uint64)
    have = 1
    while have < size:
        more = min(have, size - have)
        out[have:have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        _TABLES["up"] = _powers(_BASE, _TABLE)
        _TABLES["down"] = _powers(pow(_BASE, -1, 1 << 64), _TABLE)
    return _TABLES["up"], _TABLES["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), offsets


def slices(
    column: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: first row, last row + 1, bytes, offsets."""
    data, offsets = utf8(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(rows, max(first + 1, end))
        start = offsets[first]
        yield first, last, data[start:offsets[last]], offsets[first:last + 1] - start
        first = last


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the number of words before it."""
    if len(buf) == 0:
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = ~SPACE[buf]
    begin, stop = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    stop[:-1] &= ~solid[1:]
    heads = offsets[:-1][offsets[:-1] < len(buf)]
    tails = offsets[1:][offsets[1:] > 0] - 1
    begin[heads], stop[tails] = solid[heads], solid[tails]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offsets)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span; spans are in order and disjoint."""
    up, down = _tables()
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        origin = int(starts[first])
        if ends[first] - origin > _TABLE:
            digest = blake2b(buf[origin:ends[first]].tobytes(), digest_size=8).digest()
            out[first] = int.from_bytes(digest, "little")
            first += 1
            continue
        last = int(np.searchsorted(ends, origin + _TABLE, "right"))
        size = int(ends[last - 1]) - origin
        run = np.zeros(size + 1, np.uint64)
        np.cumsum((buf[origin:origin + size].astype(np.uint64) + np.uint64(1)) * up[:size], out=run[1:])
        a, b = starts[first:last] - origin, ends[first:last] - origin
        out[first:last] = (run[b] - run[a]) * down[a] + (b - a).astype(np.uint64)
        first = last
    return mix(out)


def word_hashes(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a slice, and the number of words before each row."""
    starts, ends, bounds = words(buf, offsets)
    return span_hashes(buf, starts, ends), bounds


def windows(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``size`` words from each word on, and whether they end in the same row."""
    n = len(hashes)
    out, whole = np.zeros(n, np.uint64), np.zeros(n, bool)
    if n >= size:
        run = hashes[:n - size + 1].copy()
        for j in range(1, size):
            run = run * _FOLD + hashes[j:n - size + 1 + j]
        out[:n - size + 1] = mix(run)
    limit = np.repeat(bounds[1:] - size, np.diff(bounds))
    whole[:] = np.arange(n) <= limit
    return out, whole


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of ``size`` words in order; a shorter text that has words is one shingle."""
    out, whole = windows(hashes, bounds, size)
    counts = np.diff(bounds)
    for row in np.flatnonzero((counts > 0) & (counts < size)):
        fold = np.uint64(counts[row])
        for h in hashes[bounds[row]:bounds[row + 1]]:
            fold = np.uint64((int(fold) * int(_FOLD) + int(h)) & 0xFFFFFFFFFFFFFFFF)
        out[bounds[row]] = mix(np.array([fold]))[0]
        whole[bounds[row]] = True
    before = np.concatenate(([0], np.cumsum(whole)))
    return out[whole], before[bounds]


def distinct_sorted(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each row, sorted within the row."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[new], np.searchsorted(rows[new], np.arange(len(bounds)))


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary per row, holding the row's values."""
    width = values.dtype.itemsize
    raw = np.ascontiguousarray(values)
    places = (bounds - bounds[0]).astype(np.int64) * width
    body = raw[bounds[0]:bounds[-1]].tobytes()
    if places[-1] < 1 << 31:
        return pa.Array.from_buffers(
            pa.binary(), len(bounds) - 1,
            [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(body)])
    return pa.array([body[a:b] for a, b in zip(places[:-1], places[1:])], pa.large_binary())
