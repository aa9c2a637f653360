"""Words of whole text columns as numpy arrays of 64-bit hashes, for use inside Arrow batches.

A word is a run of bytes outside \\x20 and \\x09-\\x0D, which in UTF-8 is the same as the pattern
``[^\\x20\\x09-\\x0D]+`` on characters. Nothing here makes a Python object for each word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = 0xD1342543DE82EF95 | 1
_SEGMENT = 1 << 18
_CHUNK = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_NOT_ALNUM = _SPACE.copy()
_NOT_ALNUM[:48] = _NOT_ALNUM[58:65] = _NOT_ALNUM[91:97] = _NOT_ALNUM[123:128] = True
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = np.arange(97, 123)

_tables: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept, and made anew at twice the size when too short."""
    table = _tables.get(base)
    if table is None or len(table) < n:
        size = max(_SEGMENT + 1, 1 << (n - 1).bit_length())
        table = np.full(size, U(base & (2**64 - 1)))
        table[0] = 1
        table = np.multiply.accumulate(table)
        _tables[base] = table
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@dataclass
class Words:
    """hash: of each word; ptr: doc i has words ptr[i] to ptr[i + 1]; start, end: their bytes in data; offsets: of documents."""

    hash: np.ndarray
    ptr: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def of_words(self) -> np.ndarray:
        """The document that each word is in."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of a text column; null counts as empty."""
    texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words(texts: pa.Array, lower: bool, bare: bool = False) -> Words:
    """Words of each text. bare: ASCII characters other than letters and digits part words as well."""
    data, offsets = flat(texts)
    n = len(data)
    edge = np.ones(n + 1, bool)
    if n:
        edge[1:n] = False
        edge[offsets] = True
        space = (_NOT_ALNUM if bare else _SPACE)[data]
        before = np.ones(n, bool)
        before[1:] = space[:-1]
        start = np.flatnonzero(~space & (before | edge[:n]))
        after = np.ones(n, bool)
        after[:-1] = space[1:]
        end = np.flatnonzero(~space & (after | edge[1:])) + 1
    else:
        start = end = np.zeros(0, np.int64)
    ptr = np.searchsorted(start, offsets)
    return Words(_hashes(data, start, end, _BYTE_LOWER if lower else _BYTE), ptr, start, end, data, offsets)


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Polynomial hash of each span, from prefix sums of byte * base**i: a span's difference over base**start."""
    out = np.empty(len(start), np.uint64)
    inverse = pow(_BASE, -1, 1 << 64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + _SEGMENT, "right")))
        a, b = int(start[i]), int(end[j - 1])
        up, down = powers(_BASE, b - a + 1), powers(inverse, b - a + 1)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(table[data[a:b]] * up[: b - a], out=total[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of hashes[i : i + k] for each i, over the end of documents too; len(hashes) - k + 1 of them."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    out = np.empty(n - k + 1, np.uint64)
    inverse = pow(_STEP, -1, 1 << 64)
    for a in range(0, n - k + 1, _SEGMENT):
        b = min(n, a + _SEGMENT + k - 1)
        up, down = powers(_STEP, b - a + 1), powers(inverse, b - a + 1)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(hashes[a:b] * up[: b - a], out=total[1:])
        m = b - a - k + 1
        out[a : a + m] = mix((total[k:] - total[:m]) * down[:m] + U(k))
    return out


def chunks(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about a MB of text each; a longer document is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes) // _CHUNK) if len(sizes) else sizes
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
