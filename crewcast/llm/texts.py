"""Words and shingles of many texts at once, as 64-bit hashes in numpy arrays.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z folded to lower case. All of these are
single bytes in UTF-8, so the bytes of a batch are hashed without decoding them or looping over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; bounds the memory of a task, some 45 bytes for each, whatever the batch holds. One text is never split.
CHUNK = 500_000

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = np.uint64(0xD1342543DE82EF95)
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, count: int) -> np.ndarray:
    known = _powers.get(int(base))
    if known is None or len(known) < count:
        steps = np.full(max(count, CHUNK), base)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if count <= 2 * CHUNK:
            _powers[int(base)] = known
    return known[:count]


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows; a null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1)
        last = min(last, len(column))
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, byte after the last) of every word; no word runs over the end of a text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ink = ~IS_SPACE[data]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    last = ink.copy()
    last[:-1] &= ~ink[1:]
    inner = offsets[1:-1][offsets[1:-1] < len(data)]
    first[inner] = ink[inner]
    inner = inner[inner > 0]
    last[inner - 1] = ink[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of the first word of every text and of the end)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts, ends = spans(data, offsets)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((FOLD[data].astype(np.uint64) + np.uint64(1)) * _power(BASE, len(data)), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _power(BASE_INVERSE, len(data))[starts])
    return hashes, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of ``size`` words of every text; a shorter text is one run, without words none."""
    joined = hashes
    for step in range(1, size):
        joined = mix(joined[: len(hashes) - step] * STEP + hashes[step:]) if len(hashes) > step else joined[:0]
    found = []
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if end - begin >= size:
            found.append(np.unique(joined[begin : end - size + 1]))
        elif end > begin:
            whole = hashes[begin : begin + 1]
            for step in range(begin + 1, end):
                whole = mix(whole * STEP + hashes[step : step + 1])
            found.append(mix(whole + np.uint64(end - begin)))
        else:
            found.append(hashes[:0])
    return found


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sets of consecutive rows) over a column of texts."""
    for row, data, offsets in chunks(column):
        yield row, shingles(*words(data, offsets), size)
