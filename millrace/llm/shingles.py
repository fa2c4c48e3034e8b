"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays.

Texts are handled as bytes in blocks, so memory follows the block and not the
batch. A hash stands for the exact bytes of a word or of a run of words; equal
runs have equal hashes, and different ones share a hash with a chance of about
2**-64 for a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_VALUE = mixed(np.arange(1, 257, dtype=np.uint64))
_POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_BLOCK, _BASE))]).astype(np.uint64)
_INVERSES = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_BLOCK, _BASE_INVERSE))]).astype(np.uint64)


def _block_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges of one block, by differences of running sums."""
    running = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[data] * _POWERS[: len(data)], out=running[1:])
    return mixed((running[ends] - running[starts]) * _INVERSES[starts] + (ends - starts).astype(np.uint64))


def _long_hash(data: np.ndarray) -> np.uint64:
    """Hash of one range that is longer than a block."""
    total = np.uint64(0)
    with np.errstate(over="ignore"):
        scale = np.uint64(1)
        for at in range(0, len(data), _BLOCK):
            part = data[at : at + _BLOCK]
            total += np.sum(_VALUE[part] * _POWERS[: len(part)], dtype=np.uint64) * scale
            scale *= _POWERS[len(part)]
        return mixed(np.array([total + np.uint64(len(data))], dtype=np.uint64))[0]


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word, and the byte behind it."""
    edges = np.flatnonzero(np.diff(~_SPACES[data], prepend=False, append=False))
    return edges[::2], edges[1::2]


def word_hashes(data: np.ndarray, bounds: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Hash of every word of one text, given as bytes, in order, or of the given byte ranges."""
    starts, ends = bounds or word_bounds(data)
    if len(data) <= _BLOCK:
        return _block_hashes(data, starts, ends)
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _BLOCK, side="right")))
        if ends[i] - starts[i] > _BLOCK:
            out[i] = _long_hash(data[starts[i] : ends[i]])
            j = i + 1
        else:
            out[i:j] = _block_hashes(data[starts[i] : ends[j - 1]], starts[i:j] - starts[i], ends[i:j] - starts[i])
        i = j
    return out


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; of the whole sequence where it is shorter; none for no words."""
    m = min(n, len(words))
    if not m:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(len(words) - m + 1, np.uint64(m))
    for k in range(m):
        total = (total ^ words[k : len(words) - m + 1 + k]) * _BASE
        total = total ^ (total >> np.uint64(29))
    return mixed(total)


def texts_as_bytes(column: pa.Array, lower: bool = True) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of every text, A-Z lower-cased; NULL counts as empty."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else [0]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        raw = data[at[i] : at[i + 1]] if valid[i] else data[:0]
        yield _LOWER[raw] if lower else raw


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of every text."""
    for raw in texts_as_bytes(column):
        yield np.unique(runs(word_hashes(raw), n))
