"""Spelling variants: words one edit apart, found over a reduced alphabet.

Every letter is hashed to one of a few symbols, which turns words into reduced words; those
that share one are a cell. Two words that are one insertion, deletion or replacement apart have
reduced words that are equal or one edit apart. So the one-edit neighbourhoods of all reduced
words, few as there are symbols, are joined with the reduced words themselves; the words of
cells that meet are compared as they are written. Each pair of reduced words is generated from
one of its ends: an insertion into one is a deletion from the other.

A cell may hold many words where letters are distributed badly. Cells of more than a bounded
number, and what they meet, go by their own letters instead: two words one replacement apart
are equal but for one place left open, two words one insertion apart are one with a letter left
out and the other. No more words can share such a key than there are letters, so there is no
group that grows with the vocabulary on either way.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.cluster import broadcast_if, is_small
from broadsheet.llm.scratch import free_shuffles, remove, written
from broadsheet.llm.textarrays import mix, signed, text_slices
from broadsheet.llm.words import distinct, pieces

# Code points of a word and its occurrences, at least, how many times as frequent
# as a word its form is, and the divisor of hashes that says where a letter is left out.
LEAST_LETTERS = 7
LEAST_COUNT = 2
TIMES = 10
DIVISOR = 31

# Symbols of the reduced alphabet, and words of a cell that are compared with those of another.
SYMBOLS = 6
CELL_WORDS = 64

# Reduced words whose neighbourhoods are worked out at a time, in letters.
STEP_LETTERS = 100_000

_BASE = 0x9E3779B97F4A7C15 | 3
_INVERSE = pow(_BASE, -1, 2**64)
_LEFT_OPEN = np.uint64(0xA24BAED5)

_ASCII = np.zeros(256, bool)
_ASCII[0x41:0x5B] = _ASCII[0x61:0x7B] = True


def letter_runs(data: np.ndarray, offsets: np.ndarray):
    """Start, end and number of code points of every maximal run of ASCII letters and code
    points from U+00C0 to U+00FF, and the offset of each row's first run in that list."""
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == 0xC3
    letter = np.zeros(len(data) + 2, bool)
    letter[1:-1] = _ASCII[data] | (data == 0xC3) | second
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(letter[1:] & (~letter[:-1] | edge))
    ends = np.flatnonzero(letter[:-1] & (~letter[1:] | edge))
    points = np.concatenate(([0], np.cumsum(~second)))
    return starts, ends, points[ends] - points[starts], np.searchsorted(starts, offsets)


def _word_rows(least_letters: int, divisor: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, _, data, offsets in text_slices(batch.column("text"), lower=True):
                starts, ends, size, bounds = letter_runs(data, offsets)
                row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                long = np.flatnonzero(size >= least_letters)
                if not len(long):
                    continue
                starts, ends, size, row = starts[long], ends[long], size[long], row[long]
                example, number = distinct(pieces(data), starts, ends)
                raw = data.tobytes()
                names = [raw[a:b] for a, b in zip(starts[example].tolist(), ends[example].tolist())]
                letters = size[example].tolist()
                counts = np.bincount(number, minlength=len(names)).astype(np.int64)
                # Each different run of a document is hashed with its id.
                pair, n = np.unique(row * len(names) + number, return_counts=True)
                docs = np.arange(len(bounds) - 1)
                before = [zlib.crc32(f"{'' if ids[first + d] is None else ids[first + d]}:".encode())
                          for d in docs.tolist()]
                changed: dict[bytes, int] = {}
                for d, w, k in zip((pair // len(names)).tolist(), (pair % len(names)).tolist(), n.tolist()):
                    h = zlib.crc32(names[w], before[d])
                    if h % divisor == 0:
                        counts[w] -= k
                        if letters[w] > least_letters:
                            word, at = names[w].decode(), h % letters[w]
                            word = (word[:at] + word[at + 1:]).encode()
                            changed[word] = changed.get(word, 0) + k
                some = np.flatnonzero(counts).tolist()
                words = [names[i].decode() for i in some] + [w.decode() for w in changed]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.string()), pa.array([*counts[some].tolist(), *changed.values()], pa.int64())],
                    names=["word", "n"])

    return work


def vocabulary(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT,
               divisor: int = DIVISOR) -> DataFrame:
    """``(word, n)``: the words of all texts and how often they occur. See ``variants``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_word_rows(least_letters, divisor), "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n")).where(F.col("n") >= least_count)


# Reduced words

class _Letters:
    """The code points of words, one after the other, as numbers from 1, and hashes of any of
    them, with letters left out or replaced, from sums of powers."""

    def __init__(self, words: pa.Array, symbols: int | None):
        text = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4").astype(np.uint64)
        size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        self.ends = np.cumsum(size)
        self.starts, self.size = self.ends - size, size
        self.values = text + np.uint64(1) if symbols is None else mix(text) % np.uint64(symbols) + np.uint64(1)
        self.word = np.repeat(np.arange(len(size)), size)
        self.place = np.arange(len(text)) - self.starts[self.word]
        powers = np.full(int(size.max(initial=0)) + 1, _BASE, np.uint64)
        powers[0] = 1
        self.power = np.cumprod(powers, dtype=np.uint64)[self.place]
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(self.values * self.power, dtype=np.uint64)))
        self.whole = self.sums[self.ends] - self.sums[self.starts]

    def finish(self, value: np.ndarray, size: np.ndarray) -> np.ndarray:
        return mix(value ^ mix(size.astype(np.uint64)))

    def hashes(self) -> np.ndarray:
        return self.finish(self.whole, self.size)

    def left_out(self) -> tuple[np.ndarray, np.ndarray]:
        """``(word, hash)`` without each letter; of a run of equal letters once."""
        first = np.ones(len(self.values), bool)
        first[1:] = (self.values[1:] != self.values[:-1]) | (self.place[1:] == 0)
        at = np.flatnonzero(first)
        word = self.word[at]
        before = self.sums[at] - self.sums[self.starts[word]]
        after = (self.sums[self.ends[word]] - self.sums[at + 1]) * np.uint64(_INVERSE)
        return word, self.finish(before + after, self.size[word] - 1)

    def replaced(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """``(word, hash)`` with each smaller letter replaced by a symbol."""
        at = np.flatnonzero(self.values < np.uint64(symbol))
        word = self.word[at]
        more = (np.uint64(symbol) - self.values[at]) * self.power[at]
        return word, self.finish(self.whole[word] + more, self.size[word])

    def left_open(self) -> tuple[np.ndarray, np.ndarray]:
        """``(word, hash)`` with each letter replaced by a sign that no word holds."""
        value = self.whole[self.word] - self.values * self.power
        return self.word, mix(self.finish(value, self.size[self.word]) ^ mix(self.place.astype(np.uint64) + _LEFT_OPEN))


def _by_letters(words: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a column of words, each of a bounded number of letters (a word at least)."""
    ends = np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(words):
        last = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + STEP_LETTERS, "right"))
        last = max(last, first + 1)
        yield first, words.slice(first, last - first)
        first = last


def _cell_rows(symbols: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words in _by_letters(batch.column("word")):
                own, cell = (_Letters(words, s).hashes() for s in (None, symbols))
                yield pa.RecordBatch.from_arrays(
                    [words, batch.column("n").slice(first, len(words)), pa.array(signed(own)),
                     pa.array(signed(cell))], names=["word", "n", "id", "cell"])

    return work


def _neighbour_rows(symbols: int):
    """Keys of the reduced words one deletion or one replacement by a greater symbol away."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            for first, words in _by_letters(batch.column("word")):
                letters = _Letters(words, symbols)
                for word, key in (letters.left_out(), *(
                        letters.replaced(s) for s in range(2, symbols + 1))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cells[first + word]), pa.array(signed(key))], names=["cell", "key"])

    return work


def _open_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of words by their own letters: ``kind`` 0 of the whole, 1 with a letter left out,
    2 with a letter left open."""
    for batch in batches:
        for first, words in _by_letters(batch.column("word")):
            letters = _Letters(words, None)
            whole = np.arange(len(words)), letters.hashes()
            for kind, (word, key) in enumerate((whole, letters.left_out(), letters.left_open())):
                at = pa.array(first + word)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(at), pa.array(np.full(len(word), kind, np.int32)),
                     pa.array(signed(key))], names=["id", "kind", "key"])


_PAIR = ["a", "a_n", "b", "b_n"]


def near_pairs(words: DataFrame, symbols: int = SYMBOLS, cell_words: int = CELL_WORDS) -> DataFrame:
    """``(a, a_n, b, b_n)``: each two of ``words(word, n)`` that are one edit apart, once."""
    spark = words.sparkSession
    placed = written(words.mapInArrow(_cell_rows(symbols), "word string, n long, id long, cell long"), "words")
    cells = written(placed.groupBy("cell").agg(
        F.min("word").alias("word"), F.count("*").alias("size")), "cells")
    keys = cells.mapInArrow(_neighbour_rows(symbols), "cell long, key long")
    met = keys.join(cells.select(F.col("cell").alias("key")), "key").where("cell != key").distinct()
    met = met.unionByName(cells.where("size > 1").select("cell", F.col("cell").alias("key")))
    size = cells.select("cell", "size")
    met = written(met.join(size, "cell").join(size.toDF("key", "key_size"), "key").select(
        "cell", "key", (F.greatest("size", "key_size") > cell_words).alias("hot")), "met")
    free_shuffles(spark)

    # Words of cells that meet, as written. Two words of one cell make one pair.
    one = placed.select("cell", F.col("word").alias("a"), F.col("n").alias("a_n"))
    two = placed.select(F.col("cell").alias("key"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    few = met.where("not hot").join(one, "cell").join(two, "key").where("cell != key or a < b")
    near = F.levenshtein("a", "b", 1) == 1
    pairs = written(few.where(near).select(*_PAIR), "near")
    free_shuffles(spark)

    hot = met.where("hot").select(F.explode(F.array("cell", "key")).alias("cell")).distinct()
    opened = written(placed.join(broadcast_if(hot, is_small(hot)), "cell", "left_semi").mapInArrow(
        _open_rows, "id long, kind int, key long"), "open")
    own = opened.select("kind", "key", F.col("id").alias("a_id"))
    other = opened.select(F.col("kind").alias("b_kind"), F.col("key").alias("b_key"), F.col("id").alias("b_id"))
    alike = own.join(other, (F.col("key") == F.col("b_key")) & (
        ((F.col("kind") == 2) & (F.col("b_kind") == 2) & (F.col("a_id") < F.col("b_id")))
        | ((F.col("kind") == 1) & (F.col("b_kind") == 0)))).select("a_id", "b_id").distinct()
    named = alike.join(placed.select(
        F.col("id").alias("a_id"), F.col("cell").alias("a_cell"), F.col("word").alias("a"), F.col("n").alias("a_n")),
        "a_id").join(placed.select(
            F.col("id").alias("b_id"), F.col("cell").alias("b_cell"), F.col("word").alias("b"), F.col("n").alias("b_n")),
        "b_id").where(near)
    # Cells that meet without being hot have been compared above.
    low, high = F.least("a_cell", "b_cell"), F.greatest("a_cell", "b_cell")
    hot_cells = met.where("hot").select(F.least("cell", "key").alias("low"), F.greatest("cell", "key").alias("high"))
    more = named.withColumn("low", low).withColumn("high", high).join(
        hot_cells.distinct(), ["low", "high"], "left_semi").select(*_PAIR).distinct()
    more = written(more, "near")
    for table in (cells, met, opened, placed):
        remove(table)
    return pairs.unionByName(more)


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms(word, form)``: where following forms ends. Each round goes
    twice as far; a form is ``TIMES`` times as frequent, so chains are short."""
    reached = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = reached.select(F.col("word").alias("at"), F.col("root").alias("next"))
        small = is_small(on)
        longer = written(reached.join(broadcast_if(on, small), F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        remove(reached)
        moved = not longer.where("moved").isEmpty()
        reached = longer.select("word", "root")
        if not moved:
            return reached


def variants(docs: DataFrame, symbols: int = SYMBOLS, cell_words: int = CELL_WORDS,
             least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, times: int = TIMES,
             divisor: int = DIVISOR) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, a row per word.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. The words are the runs of
    ASCII letters and code points from U+00C0 to U+00FF of whole texts, A-Z in lower case. Where
    ``divisor`` divides the CRC-32 ``h`` of ``<doc_id>:<run>``, the code point ``h % length`` of
    the run is left out. Words of at least ``least_letters`` code points that occur
    ``least_count`` times count; ``n`` is how often a word occurs.

    Two words are near if they differ by exactly one inserted, deleted or replaced code point;
    ``n_near`` is how many are near a word. Its ``form`` is the most frequent of them (of equal
    ones the first by code points) if that is at least ``times`` as frequent, ``form_n`` how
    often it occurs; null if there is none. ``root`` is where forms lead in the end.

    A null text has no words; a null id reads as nothing before the colon. Rows count as often
    as they are there. Without words there are no rows.
    """
    words = written(vocabulary(docs, least_letters, least_count, divisor), "vocabulary")
    free_shuffles(docs.sparkSession)
    pairs = near_pairs(words, symbols, cell_words)
    both = pairs.unionByName(pairs.select(
        F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    # Few pairs are left, and each word has a bounded number of them.
    best = F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form")))
    near = written(both.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), best.alias("best")), "best")
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= times * F.col("n"), F.struct(
            F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))).alias("best"))
    found = written(found.select("word", "n", "n_near", "best.form", "best.form_n"), "forms")
    roots = _roots(found.where("form is not null").select("word", "form"))
    return found.join(broadcast_if(roots, is_small(roots)), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
