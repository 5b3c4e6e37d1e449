"""Word and hash arrays of Arrow text batches.

Everything here is a small vectorised helper used inside Spark tasks: a batch of texts is
one byte buffer, words are runs of bytes other than space and ``\\t\\n\\v\\f\\r``, and
hashes of words or word windows come from prefix sums, so no Python code runs per word.
Blocks bound the working memory; only a single text larger than a block exceeds it.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK_BYTES = 2_000_000
HASH_BYTES = 1_000_000

SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE_BASE = 0x9E3779B97F4A7C55
_WORD_BASE = 0xD6E8FEB86659FD93


def tidy(run):
    """A batch function that hands its working memory back when a task ends: a worker lives
    on for other stages, beside workers that hold theirs."""
    @functools.wraps(run)
    def wrapped(it):
        try:
            yield from run(it)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):      # another C library
                pass
    return wrapped


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd ``base`` and of its inverse modulo 2^64."""
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(n, base, dtype=U64), np.full(n, inverse, dtype=U64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _tables.get(base)
    if have is None or len(have[0]) < n:
        have = _tables[base] = _powers(base, max(n, HASH_BYTES + 1))
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the ``len + 1`` offsets; null is empty."""
    arr = column.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes (one row at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and each text's first word index (``len + 1``)."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    space = SPACE[data]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = True, space[:-1]
    before[cuts] = True
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = True, space[1:]
    after[cuts - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word's bytes."""
    out = np.empty(len(starts), dtype=U64)
    lo = 0
    while lo < len(starts):
        hi = max(int(np.searchsorted(ends, starts[lo] + HASH_BYTES, side="right")), lo + 1)
        base, stop = starts[lo], ends[hi - 1]
        seg = data[base:stop].astype(U64) + U64(1)
        up, down = _table(_BYTE_BASE, len(seg) + 1)
        run = np.zeros(len(seg) + 1, dtype=U64)
        np.cumsum(seg * up[:len(seg)], out=run[1:])
        s, e = starts[lo:hi] - base, ends[lo:hi] - base
        out[lo:hi] = mix((run[e] - run[s]) * down[s])
        lo = hi
    return out


def window_hashes(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries (``len - k + 1`` of them)."""
    n = len(word)
    if n < k:
        return np.zeros(0, dtype=U64)
    out = np.empty(n - k + 1, dtype=U64)
    step = HASH_BYTES // 4
    for lo in range(0, len(out), step):
        hi = min(len(out), lo + step)
        part = word[lo:hi + k - 1]
        up, down = _table(_WORD_BASE, len(part) + 1)
        run = np.zeros(len(part) + 1, dtype=U64)
        np.cumsum(part * up[:len(part)], out=run[1:])
        m = hi - lo
        out[lo:hi] = (run[k:k + m] - run[:m]) * down[:m]
    return mix(out + U64(k))


def sequence_hash(word: np.ndarray) -> np.uint64:
    """Hash of a whole word sequence, of any length."""
    return window_hashes(word, len(word))[0] if len(word) else U64(0)


def to_long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def from_long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(U64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(start, start + length)`` for every pair."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    lengths = lengths.astype(np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, lengths)
