"""Word splitting and word hashing of whole Arrow string columns in numpy.

No step loops over rows or words in Python: a column's bytes are classified with a
256-entry table, words are the runs of word bytes that do not cross a row, and a
word's hash is a difference of prefix sums of a polynomial, shifted back to power 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


_tables: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _tables or len(_tables["up"]) < n:
        size = max(n, 1 << 20) + 1
        _tables["up"], _tables["down"] = _powers(_BASE, size), _powers(_INV, size)
    return _tables["up"][:n], _tables["down"][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words (the finalizer of splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: A random 64-bit value for each byte.
BYTE_VALUE = mix64(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
#: The same with A-Z as a-z.
BYTE_VALUE_LOWER = BYTE_VALUE.copy()
BYTE_VALUE_LOWER[65:91] = BYTE_VALUE[97:123]

#: True for bytes of words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: True for bytes of letters and digits; all bytes of non-ASCII characters count.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def steps(column: pa.Array, limit: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a string column: first row, end row, bytes, offsets (from 0).
    A null counts as an empty text."""
    from loomsite.llm.common import STEP_BYTES

    limit = limit or STEP_BYTES
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), len(column))
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each row the index of its first word
    (one more entry at the end)."""
    w = is_word[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = w
    now = np.zeros(len(data) + 1, dtype=bool)
    now[:-1] = w
    start = np.flatnonzero(now & (~before | edge))
    end = np.flatnonzero(before & (~now | edge))
    return start, end, np.searchsorted(start, offsets, side="left")


def running(data: np.ndarray, value: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """Prefix sums of the polynomial over all bytes, for ``between``."""
    up, _ = _power_tables(max(1, len(data)))
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(value[data] * up[: len(data)], out=sums[1:], dtype=U64)
    return sums


def between(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each range."""
    if not len(start):
        return np.zeros(0, dtype=U64)
    _, down = _power_tables(len(sums))
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(U64))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    return between(running(data, value), start, end)


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word sequences that start at each of the words but the last
    k - 1; they may cross rows, which the caller masks."""
    if len(h) < k:
        return np.zeros(0, dtype=U64)
    out = h[: len(h) - k + 1].copy()
    for j in range(1, k):
        out = mix64(out * U64(0xD6E8FEB86659FD93) + h[j : len(h) - k + 1 + j])
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``concatenate(arange(s, s + n))`` for each pair, without a loop."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - first, lengths)


def list_array(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
