"""Texts of an Arrow batch as numpy arrays: bytes, words, hashes of any span of bytes.

Everything works on whole slices of a batch at once, a few megabytes at a time, so that
memory does not depend on the number of rows, and no text is ever cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are worked on at a time; a longer text makes a slice of its own.
SLICE_BYTES = 2_000_000

# The ASCII white space of `[^\x20\x09-\x0D]+`.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all of them."""
    x = x ^ (x >> _S33)
    x *= _M1
    x ^= x >> _S33
    x *= _M2
    x ^= x >> _S33
    return x


def text_slices(column: pa.Array, lower: bool = False,
                size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of a string column, slice by slice.

    ``offsets`` has one entry more than there are rows. A null is an empty text. ``lower``
    turns A-Z into a-z. A slice has ``size`` bytes at most, or one text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary()) if pa.types.is_string(column.type) else column.cast(
        pa.large_string()).cast(pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        end = min(max(end, first + 1), n)
        part = data[offsets[first]:offsets[end]]
        yield first, end, _LOWER[part] if lower else part, offsets[first:end + 1] - offsets[first]
        first = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the offset of each row's first word in that list
    (one entry more than rows). No word crosses the end of a text."""
    n = len(data)
    letter = np.zeros(n + 2, bool)
    letter[1:-1] = ~_IS_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    inside = letter[1:]
    before = letter[:-1]
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return starts, ends, np.searchsorted(starts, offsets)


class Hasher:
    """64-bit hashes of any spans of bytes, or of any spans of a sequence of 64-bit items.

    A span hashes by a polynomial over its items modulo 2**64, taken from prefix sums, then
    mixed with its length. That is for spans of up to some 150 items: there are longer sequences
    of two items that collide under every base. Words, which may be of any length, are hashed by
    ``words.span_hashes``.
    """

    def __init__(self, seed: int = 1):
        self.seed = seed
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(0, 2**60)) * 8 + 3
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.salt = np.uint64(rng.integers(0, 2**63))
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, factor in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def prefix(self, items: np.ndarray) -> np.ndarray:
        """Prefix sums of a sequence of bytes or of 64-bit words."""
        n = len(items)
        self._powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        words = self.table[items] if items.dtype == np.uint8 else mix(items ^ self.salt)
        words *= self.up[:n]
        np.cumsum(words, out=sums[1:])
        return sums

    def raw(self, sums: np.ndarray, starts, ends) -> np.ndarray:
        """Unmixed hashes of ``[start, end)``; both may be slices or index arrays."""
        value = sums[ends] - sums[starts]
        value *= self.down[:len(sums)][starts]
        return value

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the spans ``[start, end)``, whatever their lengths."""
        value = self.raw(sums, starts, ends)
        value += (ends - starts).astype(np.uint64) * self.salt
        return mix(value)

    def windows(self, sums: np.ndarray, k: int) -> np.ndarray:
        """Hashes of all windows of ``k`` items of one sequence, in order."""
        n = len(sums) - 1
        if n < k:
            return np.zeros(0, np.uint64)
        return mix(self.raw(sums, slice(0, n - k + 1), slice(k, n + 1)))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    if len(values) < width:
        return values[:0]
    span, out = 1, values
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``start, start + 1, ...`` of many runs, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    firsts = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - firsts, lengths)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_column(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column out of flat values and offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def totals(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of values per row, as doubles, for ``n`` rows."""
    return np.bincount(rows, values, n).astype(np.float64)
