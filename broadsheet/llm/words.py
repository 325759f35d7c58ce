"""Spans of bytes, such as words: hashes, exact comparison, and which of them are different.

Hashes chain a bijection of 64-bit words over pieces of eight bytes, so spans of one length up
to eight bytes never collide, and no family of texts collides whatever the constants are.
Where a result depends on two spans being the same, their bytes are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np

from broadsheet.llm.textarrays import mix, ragged

_KEY = np.uint64(0x9E3779B97F4A7C15)

# Spans of more bytes are hashed one by one.
LONG = 256

# What is left of eight bytes, little-endian, of which so many belong to a span.
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def pieces(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each place of ``data``, and at its end, as numbers; zeros follow it."""
    room = np.zeros(len(data) + 8, np.uint8)
    room[:len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", room, strides=(1,))


def _piece(view: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    return view[at] & _MASK[np.minimum(left, 8)]


def span_hashes(view: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of the bytes behind ``view``, by ``pieces``."""
    size = ends - starts
    out = mix((size.astype(np.uint64) + np.uint64(seed << 40)) * _KEY)
    out = mix(out ^ _piece(view, starts, size))
    some, done = np.flatnonzero(size > 8), 8
    while len(some) and done < LONG:
        out[some] = mix(out[some] ^ _piece(view, starts[some] + done, size[some] - done))
        done += 8
        some = some[size[some] > done]
    if len(some):
        raw = view.base.tobytes() if isinstance(view.base, np.ndarray) else bytes(view.base)
        for i in some:
            digest = hashlib.blake2b(raw[starts[i]:ends[i]], digest_size=8, key=bytes([seed]))
            out[i] = int.from_bytes(digest.digest(), "little")
    return out


def same_spans(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray,
               size: np.ndarray) -> np.ndarray:
    """Whether each span of ``a`` has the bytes of the span of ``b`` beside it; both views are
    by ``pieces``, and both spans have ``size`` bytes."""
    same = _piece(a, a_starts, size) == _piece(b, b_starts, size)
    some, done = np.flatnonzero(same & (size > 8)), 8
    while len(some):
        equal = _piece(a, a_starts[some] + done, size[some] - done) == _piece(
            b, b_starts[some] + done, size[some] - done)
        same[some[~equal]] = False
        done += 8
        some = some[equal & (size[some] > done)]
    return same


def distinct(view: np.ndarray, starts: np.ndarray, ends: np.ndarray,
             hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(example, number)``: one place of each different span, and the number of each span
    among them. Spans that share a hash are told apart by their bytes."""
    if hashes is None:
        hashes = span_hashes(view, starts, ends)
    _, example, number = np.unique(hashes, return_index=True, return_inverse=True)
    first = example[number]
    odd = np.flatnonzero((ends - starts) != (ends - starts)[first])
    size = ends - starts
    same = same_spans(view, starts, view, starts[first], size)
    same[odd] = False
    others = np.flatnonzero(~same)
    if len(others):
        raw = view.base.tobytes() if isinstance(view.base, np.ndarray) else bytes(view.base)
        more: dict[bytes, int] = {}
        extra = []
        for i in others:
            own = raw[starts[i]:ends[i]]
            if own not in more:
                more[own] = len(example) + len(extra)
                extra.append(i)
            number[i] = more[own]
        example = np.append(example, extra)
    return example, number


class IdCache:
    """Token ids of spans, each different one encoded once as long as it is remembered.

    ``encode(data, starts, ends)`` returns the ids of some spans, one span after the other,
    and how many each has. Spans are looked up by hash in a table of slots, and their bytes are
    compared with those remembered. When there are more than ``entries``, those used only once
    since the last time are forgotten.
    """

    PROBES = 24

    def __init__(self, encode: Callable, entries: int = 500_000):
        self.encode, self.entries = encode, entries
        self.mask = (1 << (4 * entries - 1).bit_length()) - 1
        self._fill(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64),
                   np.zeros(0, np.uint8), np.zeros(0, np.int32))

    def _fill(self, keys, sizes, counts, raw, ids) -> None:
        self.slots = np.full(self.mask + 1, -1, np.int32)
        self.keys = self.sizes = self.counts = self.at = self.first = None
        self.raw, self.ids = raw, ids
        self.keys, self.sizes, self.counts = keys, sizes, counts
        self.uses = np.zeros(len(keys), np.int64)
        self._settle(0)

    def _settle(self, since: int) -> None:
        """Places of the bytes and ids of all entries, and slots of those added since."""
        self.at = np.cumsum(self.sizes) - self.sizes
        self.first = np.cumsum(self.counts) - self.counts
        self.view = pieces(self.raw)
        new = np.arange(since, len(self.keys), dtype=np.int32)
        slot = (self.keys[since:] & np.uint64(self.mask)).astype(np.int64)
        for _ in range(self.PROBES):
            if not len(new):
                break
            free = self.slots[slot] < 0
            self.slots[slot[free]] = new[free]
            lost = self.slots[slot] != new
            new, slot = new[lost], (slot[lost] + 1) & self.mask

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        found = np.full(len(hashes), -1, np.int32)
        slot = (hashes & np.uint64(self.mask)).astype(np.int64)
        entry = self.slots[slot]
        rest = np.flatnonzero(entry >= 0)
        entry = entry[rest]
        for _ in range(self.PROBES):
            hit = self.keys[entry] == hashes[rest]
            found[rest[hit]] = entry[hit]
            rest = rest[~hit]
            if not len(rest):
                break
            slot[rest] = (slot[rest] + 1) & self.mask
            entry = self.slots[slot[rest]]
            there = entry >= 0
            rest, entry = rest[there], entry[there]
        return found

    def _forget(self) -> None:
        kept = np.flatnonzero(self.uses > 1)
        if len(kept) > self.entries // 2:
            kept = np.sort(kept[np.argsort(-self.uses[kept], kind="stable")][:self.entries // 2])
        self._fill(self.keys[kept], self.sizes[kept], self.counts[kept],
                   self.raw[ragged(self.at[kept], self.sizes[kept])],
                   self.ids[ragged(self.first[kept], self.counts[kept])])

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all spans, one after the other, and how many each has."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(self.keys) > self.entries:
            self._forget()
        view, size = pieces(data), ends - starts
        hashes = span_hashes(view, starts, ends)
        entry = self._find(hashes)
        known = np.flatnonzero(entry >= 0)
        there = entry[known]
        same = self.sizes[there] == size[known]
        same &= same_spans(view, starts[known], self.view, self.at[there], np.where(same, size[known], 0))
        entry[known[~same]] = -1
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            example, number = distinct(view, starts[missing], ends[missing], hashes[missing])
            new = missing[example]
            ids, counts = self.encode(data, starts[new], ends[new])
            since = len(self.keys)
            entry[missing] = since + number
            self.keys = np.append(self.keys, hashes[new])
            self.sizes = np.append(self.sizes, size[new])
            self.counts = np.append(self.counts, counts)
            self.uses = np.append(self.uses, np.zeros(len(new), np.int64))
            self.raw = np.append(self.raw, data[ragged(starts[new], size[new])])
            self.ids = np.append(self.ids, ids)
            self._settle(since)
        self.uses += np.bincount(entry, minlength=len(self.uses))
        counts = self.counts[entry]
        return self.ids[ragged(self.first[entry], counts)], counts
