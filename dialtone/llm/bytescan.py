"""Vectorised scanning of the UTF-8 bytes under an Arrow string column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A pseudo-random odd value for each byte; A-Z have those of a-z.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
BYTE_VALUES[65:91] = BYTE_VALUES[97:123]
_POWER = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words of digits, ASCII letters and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; the text of row i is bytes[offsets[i]:offsets[i + 1]].

    Nulls are empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.empty(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return (np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0])


_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        more = np.full(max(n, 256), _POWER, dtype=np.uint64)
        more[0] = 1
        _powers = np.multiply.accumulate(more)
    return _powers[:n]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that don't cross a text's border."""
    n = len(inside)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    border = offsets[1:-1]
    border = border[(border > 0) & (border < n)]
    begins[border] = inside[border]
    ends[border - 1] |= inside[border - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """(hash, row, start, end) of every word, A-Z lower-cased; ``inside``: which bytes are of words."""
    starts, ends = runs(inside, offsets)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64), starts, ends
    length = ends - starts
    out = np.empty(len(starts), dtype=np.uint64)
    step = 1 << 17
    for a in range(0, len(starts), step):  # words in parts, so that the positions of few bytes are held
        s, k = starts[a:a + step], length[a:a + step]
        first = np.cumsum(k) - k
        place = np.arange(int(k.sum()), dtype=np.int64) - np.repeat(first, k)
        value = BYTE_VALUES[data[np.repeat(s, k) + place]] * powers(int(k.max()))[place]
        out[a:a + step] = np.add.reduceat(value, first)
    row = np.searchsorted(offsets, starts, side="right") - 1
    return mix(out), row, starts, ends


def points_before(data: np.ndarray, at: np.ndarray, base: int) -> np.ndarray:
    """Code points between byte ``base`` and each of the rising bytes ``at``."""
    if not len(at):
        return np.empty(0, np.int64)
    lead = (data[base:int(at[-1])] & 0xC0) != 0x80
    counts = np.concatenate(([0], np.cumsum(lead)))
    return counts[at - base]
