"""Words of Arrow text columns as numpy arrays: positions and 64-bit hashes.

The word classes of the contracts are classes of bytes in UTF-8 (every byte of a
non-ASCII character is a word byte in all of them), so words are found on the
bytes, vectorised. A word's hash is a polynomial in its bytes modulo 2^64, mixed.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

R = 0x9E3779B97F4A7C15  # odd
_SEGMENT = 1 << 19


def byte_table(separators, lower: bool = False) -> np.ndarray:
    """256 values: 0 for separators, else the (A-Z lower-cased) byte + 1."""
    table = np.arange(1, 257, dtype=np.uint64)
    if lower:
        table[65:91] = table[97:123]
    table[list(separators)] = 0
    return table


SPACES = [0x20, *range(0x09, 0x0E)]
PLAIN = byte_table(SPACES)
LOWERED = byte_table(SPACES, lower=True)
#: letters a-z, digits and everything beyond ASCII
ALNUM = byte_table([b for b in range(128) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)], True)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """1, r, r^2, ... modulo 2^64 for odd r, and the same of its inverse."""

    def __init__(self, r: int):
        self.r, self.inv = r, pow(r, -1, 1 << 64)
        self.reset()

    def reset(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, r in (("up", self.r), ("down", self.inv)):
                a = np.full(size, r, np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = Powers(R), Powers(0xD6E8FEB86659FD93)


@dataclass
class Words:
    data: np.ndarray  # uint8 bytes of all texts
    texts: np.ndarray  # n + 1 byte offsets of the texts
    starts: np.ndarray  # byte offsets of the words
    ends: np.ndarray
    hashes: np.ndarray  # uint64
    first: np.ndarray  # n + 1: index of each text's first word

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Text index of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def find_words(column: pa.Array, table: np.ndarray) -> Words:
    data, texts = text_bytes(column)
    inside = (table != 0)[data]
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    edge = texts[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begin[edge] = inside[edge]
    stop[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + _SEGMENT)))
        a, b = int(starts[i]), int(ends[j - 1])
        up, down = _BYTES.get(b - a)
        at = starts[i:j] - a
        hashes[i:j] = np.add.reduceat(table[data[a:b]] * up, at) * down[at]
        i = j
    return Words(data, texts, starts, ends, mix(hashes), np.searchsorted(starts, texts))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries (also across texts): n - k + 1 values."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = _WORDS.get(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up, out=total[1:])
    return mix((total[k:] - total[:-k]) * down[:n - k + 1])


def give_back() -> None:
    """Return freed memory to the system: a worker goes on to other stages."""
    for table in (_BYTES, _WORDS):
        table.reset()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run):
    """``run`` (a function of batches), giving memory back at the end of the task."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


def spans_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    step = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds at most ``limit`` bytes of ``column``, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(total, total[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each list."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def range_hashes(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of hashes[begin:end] for each pair; equal content and length, equal hash."""
    up, down = _WORDS.get(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:-1], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def pairs_in(keys: np.ndarray, owners: np.ndarray, in_keys: np.ndarray, in_owners: np.ndarray, n: int) -> np.ndarray:
    """Which (key, owner) occur among (in_keys, in_owners); owners are 0..n-1."""
    known = np.unique(in_keys)
    if not len(known) or not len(keys):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    allowed = np.unique(np.searchsorted(known, in_keys) * n + in_owners)
    return (known[at] == keys) & np.isin(at * n + owners, allowed)


def flat_list(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column of longs and the row of each; null lists are empty."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), lengths)
