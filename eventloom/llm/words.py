"""Words, shingles and fingerprints of whole Arrow string columns, in numpy.

A batch's texts are taken as one byte buffer with offsets: no Python object per text or word. Hashes are
64-bit; two different words or shingles of one corpus share one with a probability of about
(number of different ones)^2 / 2^65.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
_SOLID = np.ones(256, bool)
_SOLID[list(SPACES)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MULTIPLIER = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SLICE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@functools.lru_cache(4)
def _powers(size: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    forward = np.full(size, base, np.uint64)
    back = np.full(size, pow(base, -1, 1 << 64), np.uint64)
    forward[0] = back[0] = 1
    return np.cumprod(forward, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its texts; a null is an empty text."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most `limit` bytes of text, or one row where that is longer."""
    sizes = np.diff(buffer_of(batch.column(column))[1])
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of data[s:e] for each span; starts ascending, ends not descending."""
    out = np.empty(len(starts), np.uint64)
    values, base = _byte_values(seed), _MULTIPLIER + 2 * seed
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + _SLICE)))
        low, high = int(starts[at]), int(ends[to - 1])
        size = 1 << max(19, (high - low).bit_length())
        forward, back = _powers(size, base)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[data[low:high]] * forward[: high - low], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[e] - sums[s]) * back[s]
        at = to
    return mix(out)


def word_spans(data: np.ndarray, offsets: np.ndarray, solid_bytes: np.ndarray = _SOLID) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word (bytes other than ASCII white space, if not told otherwise) and each text's first word."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = solid_bytes[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z in lower case if wanted, and each text's first word (n + 1 entries)."""
    starts, ends, firsts = word_spans(data, offsets)
    return span_hashes(lower_ascii(data) if lower else data, starts, ends), firsts


def shingles(words: np.ndarray, firsts: np.ndarray, width: int, whole_if_short: bool) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of `width` words.

    A text with words, but fewer than `width`, has its whole sequence as one shingle or none.
    """
    rolled = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        rolled = mix(rolled * _STEP + words[k : len(words) - width + 1 + k]) if len(rolled) else rolled
    out = []
    for a, z in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if z - a >= width:
            out.append(np.unique(rolled[a : z - width + 1]))
        elif z > a and whole_if_short:
            value = np.full(1, z - a, np.uint64)
            for k in range(a, z):
                value = mix(value * _STEP + words[k : k + 1])
            out.append(value)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def texts_shingles(column: pa.Array, width: int, whole_if_short: bool) -> list[np.ndarray]:
    words, firsts = word_hashes(*buffer_of(column))
    return shingles(words, firsts, width, whole_if_short)
