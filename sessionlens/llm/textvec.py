"""Words and n-gram hashes of many texts at once, as numpy arrays over Arrow's own buffers."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of `[^\x20\x09-\x0D]+` and, once lower-cased, of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` in UTF-8.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
SLICE_BYTES = 1 << 20
#: Bytes that words() hashes at a time.
CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(64, BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x = x * U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Words(NamedTuple):
    start: np.ndarray  #: first byte of each word, in the slice
    end: np.ndarray
    hash: np.ndarray  #: 64-bit hash of each lower-cased word
    first: np.ndarray  #: for each text, its first word's number; one more at the end


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about max_bytes, a longer row alone: first row, row after the last, bytes, offsets from 0."""
    data, offsets = buffers(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Words:
    """The lower-cased (A-Z) words of the texts in one slice. Hashing takes CHUNK bytes at a time, within long words too."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, U), np.zeros(len(offsets), np.int64))
    low = _LOWER[data]
    is_word = kind[low]
    starts, ends = is_word.copy(), is_word.copy()
    starts[1:] &= ~is_word[:-1]
    ends[:-1] &= ~is_word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    starts[inner] = is_word[inner]
    ends[inner - 1] = is_word[inner - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    if not len(start):
        return Words(start, end, np.zeros(0, U), first)
    size = end - start
    total, after = np.empty(len(size), U), np.cumsum(size)
    lo = 0
    while lo < len(size):
        hi = int(np.searchsorted(after, after[lo] - size[lo] + CHUNK, "right"))
        if hi <= lo:
            total[lo], hi = _long_sum(low[start[lo] : end[lo]]), lo + 1
        else:
            part = slice(start[lo], end[hi - 1])
            total[lo:hi] = _sums(low[part][is_word[part]], size[lo:hi])
        lo = hi
    return Words(start, end, mix(total ^ (size.astype(U) << U(56))), first)


def _upto(n: int) -> np.ndarray:
    global _POW
    if n > len(_POW):
        _POW = _powers(min(2 * n, CHUNK), BASE)
    return _POW


def _sums(letters: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum of (byte + 1) * BASE ** place over each word, modulo 2 ** 64."""
    at = np.cumsum(size) - size
    inside = np.arange(len(letters)) - np.repeat(at, size)
    return np.add.reduceat((letters.astype(U) + U(1)) * _upto(int(size.max()))[inside], at)


def _long_sum(letters: np.ndarray) -> np.uint64:
    """The same of one word of more than CHUNK bytes."""
    out = 0
    for lo in range(0, len(letters), CHUNK):
        part = letters[lo : lo + CHUNK]
        out += int(_sums(part, np.array([len(part)]))[0]) * pow(BASE, lo, 1 << 64)
    return U(out % (1 << 64))


def ngrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive values of h; those that cross from one text to the next are the caller's to leave out."""
    if len(h) < k:
        return np.zeros(0, U)
    m = len(h) - k + 1
    out = np.zeros(m, U)
    for j in range(k):
        out = out * U(0xD6E8FEB86659FD93) + h[j : j + m]
    return mix(out)


def within(first: np.ndarray, k: int) -> np.ndarray:
    """For each start of a k-gram over the slice's words, whether it stays within one text."""
    n = int(first[-1])
    if n < k:
        return np.zeros(0, bool)
    ok = np.zeros(n + 1, np.int32)
    size = np.diff(first)
    full = size >= k
    np.add.at(ok, first[:-1][full], 1)
    np.add.at(ok, first[1:][full] - k + 1, -1)
    return np.cumsum(ok)[: n - k + 1] > 0


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    if len(x) < w:
        return x[:0]
    out, have = x, 1
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = w - have
    return np.minimum(out[: len(x) - w + 1], out[rest : rest + len(x) - w + 1])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
