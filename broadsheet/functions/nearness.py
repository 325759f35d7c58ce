"""Which titles are closer than a distance, for many pairs at once.

The edit distances of ``distance.too_near``, worked out in Python workers by the bit-parallel
method of Myers: a column of the table of distances is held as the bits of numbers, so 64 of its
cells take some sixteen operations, and numpy does these for thousands of pairs at a time.
These functions travel to the executors by value, as those of ``broadsheet.llm`` do: executors
need numpy and pyarrow, but not this library.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Letters of a piece at most: one for each bit of a number.
WORD = 64

# Letters that are told from each other; the rarer ones make one more class, which is like nothing.
LETTERS = 63

# This share of the letters of a piece, about, is saved where titles have nothing to do with each
# other: as many pieces as are then needed are compared first, the others if that is not enough.
USUAL = 0.3

# How many times as long the longer of two titles is at most that are compared by pieces of the shorter.
WIDEST = 16

# Pieces compared at a time, which stay in the cache of a core, and laid out at a time, of titles and of pairs.
LANES = 4096
PIECES_OF_TITLES = 16_384
PIECES_OF_PAIRS = 1 << 17

# Titles over this length are told near piece by piece, if they can be, where they are taken one by one.
LONG = 1024

# Rows of a query and a title that are told near at a time, and their bytes.
LOT_ROWS = 40_000
LOT_BYTES = 32_000_000

_ALL = np.uint64(0xFFFF_FFFF_FFFF_FFFF)
_ONE = np.uint64(1)


def edits(a: str, b: str) -> int:
    """The edit distance, with a column of the table as one number of as many bits as the longer has letters."""
    if len(a) < len(b):
        a, b = b, a
    places = dict.fromkeys(b, 0)
    if len(a) <= LONG:
        for i, c in enumerate(a):
            if c in places:
                places[c] |= 1 << i
    else:
        codes = _code_points(a)
        for c in places:
            places[c] = int.from_bytes(np.packbits(codes == ord(c), bitorder="little").tobytes(), "little")
    full = (1 << len(a)) - 1
    more, less = full, 0
    for c in b:
        eq = places[c]
        across = (((eq & more) + more) ^ more) | eq
        down = eq | less
        up = less | (full ^ ((across | more) & full))
        less_across = (more & across) << 1 & full
        up = (up << 1 | 1) & full
        more, less = less_across | (full ^ (down | up)), up & down
    return len(b) + more.bit_count() - less.bit_count()


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows with ``counts`` items each: the row of every item, and its place in the row."""
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)


class Alphabet:
    """The most frequent letters of some titles, numbered; all others have the last number."""

    def __init__(self, titles: list[str]):
        letters, counts = np.unique(_code_points("".join(titles)), return_counts=True)
        kept = letters[np.argsort(-counts, kind="stable")[:LETTERS]]
        self.size = len(kept) + 1
        self.whole = len(kept) == len(letters)
        self._number = np.full(0x110000, len(kept), np.uint8)
        self._number[kept] = np.arange(len(kept), dtype=np.uint8)

    def numbers(self, text: str) -> np.ndarray:
        return self._number[_code_points(text)]


class Coded:
    """Titles as numbers of letters; cut into even pieces of at most ``WORD`` letters, with the
    places of each letter in each piece as bits."""

    def __init__(self, titles: list[str], alphabet: Alphabet):
        size = alphabet.size
        self.alphabet = alphabet
        self.titles = titles
        self.length = np.array([len(t) for t in titles], np.int64)
        self.codes = alphabet.numbers("".join(titles))
        self.start = np.cumsum(self.length) - self.length
        self.pieces = np.maximum(1, -(-self.length // WORD))
        self.first = np.cumsum(self.pieces) - self.pieces
        of, i = _ragged(self.pieces)
        begin = i * self.length[of] // self.pieces[of]
        self.piece_length = (i + 1) * self.length[of] // self.pieces[of] - begin
        piece, place = _ragged(self.piece_length)
        self.bits = np.zeros(len(of) * size, np.uint64)
        np.add.at(self.bits, piece * size + self.codes, _ONE << place.astype(np.uint64))
        self.bits[size - 1::size] = 0
        title = np.repeat(np.arange(len(titles)), self.length)
        self.counts = np.bincount(title * size + self.codes, minlength=len(titles) * size).reshape(
            len(titles), size).astype(np.int32)


def _piece_edits(cut: Coded, piece: np.ndarray, other: Coded, start: np.ndarray,
                 count: np.ndarray) -> np.ndarray:
    """The edits between pieces of one table and runs of letters of another."""
    found = np.empty(len(piece), np.int64)
    order = np.argsort(-count, kind="stable")
    for lane in range(0, len(order), LANES):
        some = order[lane:lane + LANES]
        base, at, steps = piece[some] * cut.alphabet.size, start[some], count[some]
        more, less = np.full(len(some), _ALL), np.zeros(len(some), np.uint64)
        eq, across, down, up = (np.empty(len(some), np.uint64) for _ in range(4))
        # The longest runs are first: those that still have letters are the first so many.
        for n in np.searchsorted(-steps, -np.arange(steps[0])):
            m, l, e, x, d, u = (z[:n] for z in (more, less, eq, across, down, up))
            np.take(cut.bits, base[:n] + other.codes[at[:n]], out=e, mode="clip")
            at[:n] += 1
            np.bitwise_and(e, m, out=x)
            np.add(x, m, out=x)
            np.bitwise_xor(x, m, out=x)
            np.bitwise_or(x, e, out=x)
            np.bitwise_or(e, l, out=d)
            np.bitwise_or(x, m, out=u)
            np.invert(u, out=u)
            np.bitwise_or(u, l, out=u)
            np.bitwise_and(x, m, out=x)
            np.left_shift(u, _ONE, out=u)
            np.bitwise_or(u, _ONE, out=u)
            np.left_shift(x, _ONE, out=x)
            np.bitwise_and(u, d, out=l)
            np.bitwise_or(d, u, out=d)
            np.invert(d, out=d)
            np.bitwise_or(x, d, out=m)
        used = _ALL >> (WORD - cut.piece_length[piece[some]]).astype(np.uint64)
        found[some] = (steps + np.bitwise_count(more & used).astype(np.int64)
                       - np.bitwise_count(less & used).astype(np.int64))
    return found


def _near_by_pieces(longer: Coded, one: np.ndarray, shorter: Coded, other: np.ndarray,
                    enough: float) -> np.ndarray:
    """Which pairs of titles a way piece by piece from one to the other tells near. Titles of
    ``longer`` have a letter at least, and are as long as the others or longer."""
    near = np.zeros(len(one), bool)
    pieces = longer.pieces[one]
    ends = np.cumsum(pieces)
    begin = 0
    while begin < len(one):
        # So many pairs as have no more pieces than are laid out at a time, and one at least.
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] - pieces[begin] + PIECES_OF_PAIRS, "right")))
        saved = np.zeros(end - begin, np.int64)
        pairs = np.arange(end - begin)
        done = np.zeros(end - begin, np.int64)
        for share in (min(1.0, max(0.0, (1 - enough) / USUAL)), 1.0):
            upto = np.ceil(pieces[begin:end][pairs] * share).astype(np.int64)
            row, i = _ragged(np.maximum(upto - done[pairs], 0))
            if len(row):
                pair = pairs[row]
                i = i + done[pair]
                a, b, n = one[begin + pair], other[begin + pair], pieces[begin + pair]
                piece = longer.first[a] + i
                start = i * shorter.length[b] // n
                count = (i + 1) * shorter.length[b] // n - start
                gain = longer.piece_length[piece] - _piece_edits(
                    longer, piece, shorter, shorter.start[b] + start, count)
                saved += np.bincount(pair, gain, minlength=end - begin).astype(np.int64)
                done[pairs] = upto
            length = longer.length[one[begin:end]]
            near[begin:end] = (length - saved) / length < enough
            pairs = np.flatnonzero(~near[begin:end])
        begin = end
    return near


def _near_as_a_whole(shorter: Coded, one: np.ndarray, longer: Coded, other: np.ndarray,
                     enough: float) -> np.ndarray:
    """The same with the pieces of the shorter title. Where it is one piece, this is the edit distance,
    if the alphabet is whole. Titles of ``shorter`` have a letter at least."""
    row, i = _ragged(shorter.pieces[one])
    a, b = one[row], other[row]
    start = i * longer.length[b] // shorter.pieces[a]
    count = (i + 1) * longer.length[b] // shorter.pieces[a] - start
    found = _piece_edits(shorter, shorter.first[a] + i, longer, longer.start[b] + start, count)
    return np.bincount(row, found, minlength=len(one)) / longer.length[other] < enough


def _told_near(x: Coded, one: np.ndarray, y: Coded, other: np.ndarray, enough: float) -> np.ndarray:
    """Which pairs of titles are told near by pieces of the longer one; none that lengths tell apart."""
    near = np.zeros(len(one), bool)
    a, b = x.length[one], y.length[other]
    longest = np.maximum(a, b)
    open_ = (longest > 0) & (np.abs(a - b) < enough * longest + 1)
    for of, first, second in ((open_ & (a >= b), (x, one), (y, other)), (open_ & (a < b), (y, other), (x, one))):
        of = np.flatnonzero(of)
        if len(of):
            near[of] = _near_by_pieces(first[0], first[1][of], second[0], second[1][of], enough)
    return near


def _told(x: Coded, one: np.ndarray, y: Coded, other: np.ndarray, enough: float) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs pieces of the shorter title tell near, and of which pairs that is all there is to say."""
    near, said = np.zeros(len(one), bool), _apart(x, one, y, other, enough)
    a, b = x.length[one], y.length[other]
    open_ = ~said & (WIDEST * np.minimum(a, b) >= np.maximum(a, b))
    for of, first, second in ((open_ & (a <= b), (x, one), (y, other)), (open_ & (a > b), (y, other), (x, one))):
        of = np.flatnonzero(of)
        if len(of):
            near[of] = _near_as_a_whole(first[0], first[1][of], second[0], second[1][of], enough)
            said[of] = near[of] | (x.alphabet.whole & (first[0].pieces[first[1][of]] == 1))
    return near, said


def _apart(x: Coded, one: np.ndarray, y: Coded, other: np.ndarray, enough: float) -> np.ndarray:
    """Which pairs lengths, or the numbers of each letter, tell apart: see ``distance.least_distance``."""
    a, b = x.length[one], y.length[other]
    longest = np.maximum(a, b)
    over = x.counts[one] - y.counts[other]
    least = np.maximum(np.maximum(over, 0).sum(1), np.maximum(-over, 0).sum(1))
    return (longest == 0) | (np.maximum(least, np.abs(a - b)) / np.maximum(longest, 1) >= enough)


class Taken:
    """The titles taken for each query, and which others are near one of them."""

    def __init__(self, titles_of: dict[str, list[str | None]], min_distance: float):
        self.enough = min_distance
        titles = list(dict.fromkeys(t for own in titles_of.values() for t in own if t is not None))
        number = {t: i for i, t in enumerate(titles)}
        self.of = {query: [number[t] for t in own if t is not None] for query, own in titles_of.items()}
        self.alphabet = Alphabet(titles)
        self.coded = Coded(titles, self.alphabet)

    def near(self, queries: pa.Array, titles: pa.Array) -> np.ndarray:
        """For rows of a query and a title: whether the title is near one that the query has taken."""
        rejected = np.zeros(len(queries), bool)
        query, title = queries.dictionary_encode(), titles.dictionary_encode()
        lists = [self.of.get(q, []) for q in query.dictionary.to_pylist()]
        most = max(map(len, lists), default=0)
        if not most or not self.coded.titles:
            return rejected
        table = np.full((len(lists), most), -1, np.int64)
        for i, own in enumerate(lists):
            table[i, :len(own)] = own
        known = np.asarray(queries.is_valid()) & np.asarray(titles.is_valid())
        q = query.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        t = title.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        texts = title.dictionary.to_pylist()
        lots = np.cumsum([max(1, -(-len(text) // WORD)) for text in texts]) // PIECES_OF_TITLES
        for lot in np.unique(lots):
            first, end = np.searchsorted(lots, lot), np.searchsorted(lots, lot, "right")
            rows = np.flatnonzero(known & (t >= first) & (t < end))
            coded = Coded(texts[first:end], self.alphabet)
            rejected[rows] = self._near(coded, table[q[rows]], t[rows] - first)
        return rejected

    def _near(self, coded: Coded, lists: np.ndarray, title: np.ndarray) -> np.ndarray:
        """``lists``: the taken titles that each row is compared with, filled up with -1."""
        n = len(self.coded.titles)
        near = np.zeros(len(title), bool)
        said: set[int] = set()  # pairs that are known not to be near

        def by_pieces(keys: np.ndarray) -> np.ndarray:
            return _told_near(coded, keys // n, self.coded, keys % n, self.enough)

        def by_shorter_pieces(keys: np.ndarray) -> np.ndarray:
            found, sure = _told(coded, keys // n, self.coded, keys % n, self.enough)
            said.update(keys[sure & ~found].tolist())
            return found

        def by_letters(keys: np.ndarray) -> np.ndarray:
            one, other = keys // n, keys % n
            found = np.zeros(len(keys), bool)
            for i in np.flatnonzero([int(key) not in said for key in keys]):
                a, b = coded.titles[one[i]], self.coded.titles[other[i]]
                found[i] = edits(a, b) / max(len(a), len(b)) < self.enough
                said.update([] if found[i] else [int(keys[i])])
            return found

        # Near one is enough, so all are tried piece by piece before any is compared letter by letter.
        for told in (by_pieces, by_shorter_pieces, by_letters):
            for others in lists.T:
                rows = np.flatnonzero(~near & (others >= 0))
                if len(rows):
                    keys, back = np.unique(title[rows] * n + others[rows], return_inverse=True)
                    near[rows] = told(keys)[back]
        return near


def are_near(a: str | None, b: str | None, enough: float) -> bool:
    """``distance.too_near`` of two titles."""
    if a is None or b is None or not (a or b):
        return False
    longest = max(len(a), len(b))
    if abs(len(a) - len(b)) / longest >= enough:
        return False
    if a == b:
        return True
    if longest > LONG:
        one, other = sorted((a, b), key=len, reverse=True)
        alphabet = Alphabet([a, b])
        if _near_by_pieces(Coded([one], alphabet), np.array([0]), Coded([other], alphabet), np.array([0]), enough)[0]:
            return True
    x, y = Counter(a), Counter(b)
    if max((x - y).total(), (y - x).total()) / longest >= enough:
        return False
    return edits(a, b) / longest < enough


def picked(taken: list[str | None], candidates: list[str | None], k: int, min_distance: float) -> list[int]:
    """Which candidates, in their order, keep the distance from all titles taken before them, until
    there are ``k`` with those that are taken already."""
    titles, found = list(taken), []
    for i, title in enumerate(candidates):
        if len(titles) >= k:
            break
        if min_distance <= 0 or not any(are_near(t, title, min_distance) for t in titles):
            titles.append(title)
            found.append(i)
    return found


def picked_of(taken: Column, candidates: Column, k: int, min_distance: float) -> Column:
    """``picked`` of two columns of arrays of titles."""
    def pick(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for taken, candidates in batches:
            yield pa.array([picked(t.as_py(), c.as_py(), k, min_distance) for t, c in zip(taken, candidates)],
                           pa.list_(pa.int32()))

    return F.arrow_udf(pick, "array<int>")(taken, candidates)


def _lots(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[list[tuple[pa.Array, ...]]]:
    """Some batches at a time, as numpy is quicker with many rows."""
    lot: list[tuple[pa.Array, ...]] = []
    rows = size = 0
    for batch in batches:
        lot.append(batch)
        rows, size = rows + len(batch[0]), size + sum(column.nbytes for column in batch)
        if rows >= LOT_ROWS or size >= LOT_BYTES:
            yield lot
            lot, rows, size = [], 0, 0
    if lot:
        yield lot


def near_taken(query: Column, title: Column, titles_of: dict[str, list[str | None]], min_distance: float) -> Column:
    """Whether a title is near one of those in a list of its query, a string."""
    def near(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        taken = Taken(titles_of, min_distance)
        for lot in _lots(batches):
            queries, titles = (pa.concat_arrays(column) for column in zip(*lot))
            found, begin = pa.array(taken.near(queries, titles)), 0
            for column, _ in lot:
                yield found.slice(begin, len(column))
                begin += len(column)

    return F.arrow_udf(near, "boolean")(query, title)


def near_listed(query: Column, title: Column, listed: Column, min_distance: float) -> Column:
    """The same where the list, the same for all rows of a query, is a column."""
    def near(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for queries, titles, lists in batches:
            first: dict[str, list] = {}
            encoded = queries.dictionary_encode()
            seen, rows = np.unique(encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False), return_index=True)
            for i, row in zip(seen, rows):
                if i >= 0:
                    first[encoded.dictionary[int(i)].as_py()] = lists[int(row)].as_py() or []
            yield pa.array(Taken(first, min_distance).near(queries, titles))

    return F.arrow_udf(near, "boolean")(query, title, listed)
