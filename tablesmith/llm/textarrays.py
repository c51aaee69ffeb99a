"""Whole Arrow text columns as numpy arrays: words, hashes, shingles.

Everything here works on the UTF-8 bytes of a slice of a column at once, so a
task's memory follows the slice (``SLICE_BYTES``, or one longer document).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

#: The contracts' separators, [\x20\x09-\x0D].
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BYTE_CODE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """step**i and step**-i modulo 2**64 for i < n; kept for the next slice."""
    if len(_powers[0]) < n:
        size = 1 << max(n - 1, 1 << 17).bit_length()
        for k, base in enumerate((_STEP, _STEP_INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


#: What modules keep in a worker for the next task of their stage.
caches: list[dict] = []


def handed_back() -> None:
    """Give freed memory, the power tables and what other stages kept back to the system: an idle worker keeps what it once took."""
    for kept in caches:
        kept.clear()
    _powers[:] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def slices(batch: pa.RecordBatch, text_col: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for runs of rows of at most ``limit`` bytes; a null text counts as empty.

    A single longer document comes alone and whole.
    """
    col = batch.column(batch.schema.get_field_index(text_col))
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    n = len(col)
    if not n:
        return
    buffers = col.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[col.offset: col.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield batch.slice(i, j - i), data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray, lower: bool = True,
               separators: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, row of each word); words never cross rows. ``separators`` has a flag for each byte."""
    b = _LOWER[data] if lower else data
    n = len(b)
    empty = np.zeros(0, dtype=np.int64)
    if not n:
        return b, empty, empty, empty
    sep = separators[b]
    before = np.empty(n, dtype=bool)
    before[0] = True
    before[1:] = sep[:-1]
    inner = offsets[:-1]
    before[inner[inner < n]] = True
    starts = np.flatnonzero(~sep & before)
    after = np.empty(n, dtype=bool)
    after[-1] = True
    after[:-1] = sep[1:]
    last = offsets[1:]
    after[last[last > 0] - 1] = True
    ends = np.flatnonzero(~sep & after) + 1
    return b, starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, from prefix sums: equal bytes give equal hashes wherever they stand."""
    return hashes_between(prefix_sums(b), starts, ends)


def prefix_sums(b: np.ndarray) -> np.ndarray:
    """What ``hashes_between`` needs of some bytes."""
    sums = np.empty(len(b) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_CODE[b] * _power_tables(len(b) + 1)[0][: len(b)], out=sums[1:])
    return sums


def hashes_between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * _power_tables(len(sums))[1][starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, bounds of each row's words)."""
    b, starts, ends, rows = word_spans(data, offsets, lower)
    return span_hashes(b, starts, ends), np.searchsorted(rows, np.arange(len(offsets)))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` consecutive hashes (windows may cross rows; callers cut them)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = out * _STEP + words[k: k + n]
    return mix(out)


def shingle_set(words: np.ndarray, windows: np.ndarray, start: int, end: int, size: int) -> np.ndarray:
    """Sorted distinct shingles of the row whose words are words[start:end]; a shorter row is one shingle, an empty one none."""
    n = end - start
    if n >= size:
        return np.unique(windows[start: end - size + 1])
    if not n:
        return np.zeros(0, dtype=np.uint64)
    h = np.uint64(n)
    with np.errstate(over="ignore"):
        for w in words[start:end]:
            h = h * _STEP + w
    return mix(np.array([h], dtype=np.uint64))

