"""Word tables of many texts at once, as numpy arrays.

Texts are joined with line feeds (a separator under every word rule used here) and
handled as one array of bytes, so no Python object is made per word. A slice of a
batch holds about ``SLICE_BYTES`` of text, or one longer text; memory in a task is a
small multiple of that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

# Separators of the two word rules, as bytes.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

# Two odd multipliers; together they give 128 bits per word or window.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: dict[int, np.ndarray] = {}


def row_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """``(first row, texts)`` of consecutive rows; a null text is empty."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    data = column.cast(pa.binary())
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield first, [t or b"" for t in data.slice(first, i - first).to_pylist()]
            first, held = i, 0
        held += int(size) + 1
    if first < len(sizes):
        yield first, [t or b"" for t in data.slice(first).to_pylist()]


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        table = np.full(max(n, SLICE_BYTES + (1 << 16)), base, np.uint64)
        table[0] = 1
        have = np.multiply.accumulate(table)
        if n <= SLICE_BYTES * 4:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of some texts: ``starts`` and ``ends`` in ``blob``, and ``first[i]``, the index of the first word of text i."""

    def __init__(self, texts: list[bytes], separators: bytes, lower: bool):
        joined = b"\n".join(texts) + b"\n"
        self.blob = joined.translate(LOWER) if lower else joined
        self.bytes = np.frombuffer(self.blob, np.uint8)
        kind = np.ones(256, np.int8)
        kind[list(separators)] = 0
        inside = kind[self.bytes]
        change = np.diff(inside, prepend=np.int8(0))
        self.starts, self.ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        at = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.first = np.searchsorted(self.starts, at)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    def row(self) -> np.ndarray:
        """Index of the text of every word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def position(self) -> np.ndarray:
        """Index of every word in its text."""
        return np.arange(len(self)) - np.repeat(self.first[:-1], self.counts)

    def left(self) -> np.ndarray:
        """Words of the same text from each word on, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self))

    def hashes(self, base: int = BASES[0]) -> np.ndarray:
        """A 64-bit hash of every word, the same in any process."""
        n = len(self.bytes)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * powers(base, n), out=sums[1:])
        inverse = powers(pow(base, -1, 1 << 64), n)
        return mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts])

    def word(self, i: int) -> bytes:
        return self.blob[self.starts[i]:self.ends[i]]


def grams(hashes: np.ndarray, k: int, base: int = BASES[0]) -> np.ndarray:
    """Hash of the k words from each word on. The last k - 1 values run past the end and mean nothing."""
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)])
    total = np.zeros(len(hashes), np.uint64)
    for j in range(k):
        total = total * np.uint64(base) + padded[j:j + len(hashes)]
    return mix(total)


def window_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the least of ``width`` values from each index on; the last of equal ones. Short by width - 1."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best = values[:n].copy()
    where = np.arange(n)
    for j in range(1, width):
        other = values[j:j + n]
        lower = other <= best
        np.copyto(best, other, where=lower)
        np.copyto(where, np.arange(j, j + n), where=lower)
    return where
