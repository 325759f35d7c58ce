"""Suffix-array dedup: repeated strings of 100 bytes, found by a multi-document index.

The collection to index is made of the open runs of ``repeats``: strings of at most 156
bytes that share a minimizer with another string. They are dealt out by minimizer, and where
one has too many, by ever longer pieces around it, so that equal strings of 100 bytes meet in
one task, and each task indexes one block of bounded size
after the other. The Burrows-Wheeler transform and the common prefixes of a block are built
column by column: each round puts one more symbol of every string, from its end to its
beginning, into both sequences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.cluster import broadcast_if, is_small
from broadsheet.llm.repeats import (
    BYTES, SPAN, merged, open_texts, repeated_runs, run_lists, texts_by_id, with_spans,
)
from broadsheet.llm.scratch import free_shuffles, remove, written
from broadsheet.llm.textarrays import Hasher, mix, ragged, signed, text_slices

# Bytes of strings that are indexed together.
BLOCK_BYTES = 600_000

# Bytes of strings of one key. Where there are more, the key is made finer.
KEY_BYTES = 200_000

STRING = "m long, doc_id long, start int, n int, at int, string binary"
KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


class ColumnwiseIndex:
    """Burrows-Wheeler transform and common prefixes of a collection of byte strings.

    After round ``r`` both sequences cover the suffixes of up to ``r`` symbols of every
    string. The transform is held as its symbols with their places, sorted by symbol and
    then place: the index of an entry is the rank that sends its suffix, longer by that
    symbol, to its place. A round reads both sequences from beginning to end, writes them
    anew with one more suffix of every string, and takes the common prefix with a new
    neighbour as one more than the least common prefix between the two shorter suffixes.
    """

    PLACE = np.int64((1 << 40) - 1)

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.offsets = offsets
        lengths = np.diff(offsets)
        n = self.n = len(lengths)
        symbols = data.astype(np.int64) + 1 << 40

        def entries(strings: np.ndarray, r: int, places: np.ndarray):
            """The strings with a symbol before their suffix of ``r`` symbols, and entries
            for these symbols, in order."""
            some = lengths[strings] > r
            strings, places = strings[some], places[some]
            keys = symbols[offsets[strings + 1] - r - 1] | places
            by = np.argsort(keys)
            return strings[by], keys[by]

        lcp = np.zeros(n, np.uint8)
        active, bwt = entries(np.arange(n), 0, np.arange(n))
        rank = np.arange(len(bwt))
        for r in range(1, int(lengths.max(initial=0)) + 1):
            is_new = np.zeros(len(bwt) + 1, bool)
            is_new[rank] = True
            is_new[1:] |= is_new[:-1].copy()
            changed = np.flatnonzero(is_new[:-1])
            common = self._common(bwt, lcp, changed)
            size = n + len(bwt)
            old = np.ones(size, bool)
            old[n + rank] = False
            prefixes = np.empty(size, np.uint8)
            prefixes[old] = lcp
            prefixes[n + changed] = common
            lcp = prefixes
            moved = np.flatnonzero(old)
            places = moved[bwt & self.PLACE]
            bwt &= ~self.PLACE
            bwt |= places
            active, keys = entries(active, r, n + rank)
            rank = np.searchsorted(bwt, keys) + np.arange(len(keys))
            grown = np.empty(len(bwt) + len(keys), np.int64)
            old = np.ones(len(grown), bool)
            old[rank] = False
            grown[old] = bwt
            grown[rank] = keys
            bwt = grown
        self.bwt, self.lcp = bwt, lcp

    def _common(self, bwt, lcp, changed) -> np.ndarray:
        """Common prefixes of the suffixes at ``changed`` ranks with the ones before."""
        out = np.zeros(len(changed), np.uint8)
        this, last = bwt[changed], bwt[changed - 1]
        same = np.flatnonzero((changed > 0) & ((this ^ last) <= self.PLACE))
        if len(same):
            begin, end = (last[same] & self.PLACE) + 1, (this[same] & self.PLACE) + 1
            by = np.argsort(begin)
            pairs = np.stack([begin[by], end[by]], 1).ravel()
            least = np.minimum.reduceat(np.append(lcp, np.uint8(0)), pairs)[::2]
            out[same[by]] = least + np.uint8(1)
        return out

    def suffixes(self) -> tuple[np.ndarray, np.ndarray]:
        """String and length of each suffix, in sorted order."""
        step = np.full(len(self.lcp), -1, np.int64)
        step[self.bwt & self.PLACE] = self.n + np.arange(len(self.bwt))
        string = np.empty(len(step), np.int64)
        length = np.empty(len(step), np.int64)
        at, who, r = np.arange(self.n), np.arange(self.n), 0
        while len(at):
            string[at], length[at] = who, r
            at = step[at]
            who, at = who[at >= 0], at[at >= 0]
            r += 1
        return string, length


def repeats_of_block(doc: np.ndarray, start: np.ndarray, data: np.ndarray, offsets: np.ndarray,
                     width: int = BYTES.width) -> tuple[np.ndarray, np.ndarray]:
    """``(document, start)`` of the windows of a block that occur earlier in it too."""
    index = ColumnwiseIndex(data, offsets)
    string, length = index.suffixes()
    group = np.cumsum(index.lcp < width)
    whole = np.flatnonzero(length >= width)
    string, group = string[whole], group[whole]
    place = start[string] + np.diff(offsets)[string] - length[whole]
    by = np.lexsort((place, doc[string], group))
    string, group, place = string[by], group[by], place[by]
    same = np.zeros(len(by), bool)
    same[1:] = group[1:] == group[:-1]
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(by)))) if len(by) else by
    later = (doc[string] != doc[string[first]]) | (place != place[first])
    return doc[string[later]], place[later]


def _binary(data: np.ndarray, size: np.ndarray) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(size), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column, and its offsets in them."""
    ends = np.frombuffer(strings.buffers()[1], np.int32)[
        strings.offset:strings.offset + len(strings) + 1].astype(np.int64)
    data = strings.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[ends[0]:ends[-1]], ends - ends[0]


def minimizer_places(m: np.ndarray, data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> np.ndarray:
    """Where the minimizer of each string is in it: at the first gram with its hash."""
    grams = hasher.windows(hasher.prefix(data), BYTES.k)
    row = np.repeat(np.arange(len(m)), np.diff(offsets))[:len(grams)]
    same = np.flatnonzero(grams == m.view(np.uint64)[row])
    same = same[same + BYTES.k <= offsets[1:][row[same]]]
    at = np.zeros(len(m), np.int64)
    at[row[same][::-1]] = same[::-1] - offsets[row[same][::-1]]
    return at


def _string_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for first, end, data, offsets in text_slices(batch.column("text")):
            rows, m, start, n = run_lists(batch, first, end)
            size = n + BYTES.width - 1
            chosen = data[ragged(offsets[rows] + start, size)]
            at = minimizer_places(m, chosen, np.concatenate(([0], np.cumsum(size))), hasher)
            yield pa.RecordBatch.from_arrays(
                [pa.array(m), pa.array(ids[first + rows]), pa.array(start.astype(np.int32)),
                 pa.array(n.astype(np.int32)), pa.array(at.astype(np.int32)), _binary(chosen, size)],
                names=["m", "doc_id", "start", "n", "at", "string"])


def _finer_rows(width: int):
    """Strings cut by where the minimizer is in a window: windows with its place in one range of
    ``width`` make a string, and the bytes that all of them share, more than the minimizer alone,
    make its key. Equal windows have the minimizer in the same place, so they keep meeting."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, places = Hasher(), BYTES.width - BYTES.k + 1
        for batch in batches:
            data, offsets = _bytes_of(batch.column("string"))
            doc = batch.column("doc_id")
            start, n, at = (batch.column(c).to_numpy().astype(np.int64) for c in ("start", "n", "at"))
            sums = hasher.prefix(data)
            for low in range(0, places, width):
                high = min(low + width, places)
                first, end = np.maximum(at - high + 1, 0), np.minimum(at - low + 1, n)
                some = np.flatnonzero(first < end)
                first, end = first[some], end[some]
                size = end - first + BYTES.width - 1
                shared = offsets[some] + at[some]
                key = hasher.spans(sums, shared - low, shared + BYTES.width + 1 - high)
                key = mix(key ^ mix(np.full(len(key), low * places + width, np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(key)), doc.take(pa.array(some)),
                     pa.array((start[some] + first).astype(np.int32)), pa.array((end - first).astype(np.int32)),
                     pa.array((at[some] - first).astype(np.int32)),
                     _binary(data[ragged(offsets[some] + first, size)], size)],
                    names=["m", "doc_id", "start", "n", "at", "string"])

    return rows


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by ``m``, cut into tables of about BLOCK_BYTES that no ``m`` crosses."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        while batch.num_rows:
            lengths = np.diff(np.frombuffer(batch.column("string").buffers()[1], np.int32)[
                batch.column("string").offset:batch.column("string").offset + batch.num_rows + 1])
            m = batch.column("m").to_numpy()
            if size >= BLOCK_BYTES:
                other = np.flatnonzero(m != held[-1].column("m")[held[-1].num_rows - 1].as_py())
                cut = int(other[0]) if len(other) else batch.num_rows
                if cut:
                    held.append(batch.slice(0, cut))
                if len(other):
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
            else:
                cut = int(np.searchsorted(np.cumsum(lengths), BLOCK_BYTES - size)) + 1
                cut = min(cut, batch.num_rows)
                held.append(batch.slice(0, cut))
                size += int(lengths[:cut].sum())
            batch = batch.slice(cut)
    if held:
        yield pa.Table.from_batches(held)


def _block_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _blocks(batches):
        strings = table.column("string").combine_chunks()
        if isinstance(strings, pa.ChunkedArray):
            strings = strings.chunk(0)
        data, offsets = _bytes_of(strings)
        doc, place = repeats_of_block(
            table.column("doc_id").to_numpy(), table.column("start").to_numpy().astype(np.int64),
            data, offsets)
        if not len(doc):
            continue
        order = np.lexsort((place, doc))
        doc, place = doc[order], place[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (place[1:] > place[:-1] + 1)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(doc)) - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[heads]), pa.array(place[heads].astype(np.int32)),
             pa.array((place[tails] - place[heads] + 1).astype(np.int32))],
            names=["doc_id", "start", "n"])


def repeated_strings(docs: DataFrame) -> DataFrame:
    """``(doc_id, start, n)``: runs of 100-byte strings that also start earlier: in a
    document of smaller id, or earlier in the same one."""
    spark = docs.sparkSession
    again, opened = repeated_runs(docs, BYTES)
    strings = written(open_texts(docs, opened).mapInArrow(_string_rows, STRING), "strings")
    free_shuffles(spark)
    repeats = [again]
    for width in _WIDTHS:
        indexed, strings, equal = _split_hot(strings, width)
        repeats.append(written(indexed.repartition("m").sortWithinPartitions("m").mapInArrow(
            _block_repeats, SPAN), "indexed"))
        free_shuffles(spark)
        if strings is None:
            break
        repeats.append(equal)
    return reduce(DataFrame.unionByName, repeats)


# Ranges of places of the minimizer in a window, the whole first; in the end all windows of a key
# are equal, and no key has more than one string.
_WIDTHS = (29, 15, 8, 4, 2, 1, 1)


def _split_hot(strings: DataFrame, width: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """The strings of keys of bounded size, to be indexed; those of the others by finer keys, each
    different one once, at its first place; and ``(doc_id, start, n)`` of its other places."""
    bytes_of = F.sum(F.col("n") + (BYTES.width - 1))
    hot = written(strings.groupBy("m").agg(bytes_of.alias("bytes")).where(
        F.col("bytes") > KEY_BYTES).select("m"), "hot")
    if hot.isEmpty():
        return strings, None, None
    small = is_small(hot)
    finer = written(strings.join(broadcast_if(hot, small), "m", "left_semi").mapInArrow(
        _finer_rows(width), STRING).withColumn("s", F.xxhash64("string")), "finer")
    one = finer.groupBy("m", "s", "n").agg(
        F.min(F.struct("doc_id", "start", "at", "string")).alias("first"), F.count("*").alias("c"))
    one = written(one, "once")
    several = one.where("c > 1").select(
        "m", "s", "n", F.struct("first.doc_id", "first.start").alias("place"))
    equal = written(finer.join(several, ["m", "s", "n"]).where(
        F.struct("doc_id", "start") != F.col("place")).select("doc_id", "start", "n"), "equal")
    once = one.select("m", "first.doc_id", "first.start", "n", "first.at", "first.string")
    remove(finer)
    return strings.join(broadcast_if(hot, small), "m", "left_anti"), once, equal


def _kept_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for doc_id, text, *runs in frame.itertuples(index=False, name=None):
            raw = (text or "").encode()
            gone = merged(*runs, BYTES.width, len(raw)).tolist()
            edges = [0, *(x for span in gone for x in span), len(raw)]
            kept = hashlib.sha256()
            for a, b in zip(edges[::2], edges[1::2]):
                kept.update(raw[a:b])
            out.append((doc_id, len(raw), sum(b - a for a, b in gone), len(gone), kept.hexdigest()))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in KEPT.split(", ")]).astype(
            {"doc_id": "Int64"})


def removed_strings(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal
    removed runs) and ``kept_sha256``, of the bytes that stay.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. A byte goes when a string
    of 100 bytes around it also starts earlier. Strings are judged on the input and never
    cross documents. A null text is empty; texts under 100 bytes stay whole, whatever they
    are; an empty table gives an empty result. Rows without an id repeat nothing and stay
    whole. Repeated rows (one id, one text) are one document: each gives the same row.
    """
    spans, _, _ = with_spans(texts_by_id(docs), repeated_strings(docs))
    return spans.mapInPandas(_kept_rows, KEPT)


def _clean_texts(starts_name: str, ends_name: str):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = []
            for text, starts, ends in zip(frame["text"], frame[starts_name], frame[ends_name]):
                if text is not None and starts is not None:
                    raw = text.encode()
                    edges = [0]
                    for a, b in merged(starts, ends, BYTES.width, len(raw)).tolist():
                        while a < b and raw[a] & 0xC0 == 0x80:  # whole characters only
                            a += 1
                        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
                            b -= 1
                        edges += [a, b]
                    edges.append(len(raw))
                    text = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])).decode()
                texts.append(text)
            yield frame.assign(text=texts).drop(columns=[starts_name, ends_name])

    return rows


def without_repeated_strings(docs: DataFrame) -> DataFrame:
    """The documents with every repeated string of 100 bytes taken out of their texts but
    for its first place, cut at whole characters; ``n_chars``, if there is such a column,
    is counted again. No row is dropped; see ``removed_strings`` for the rules."""
    spans, starts, ends = with_spans(docs, repeated_strings(docs))
    clean = spans.mapInPandas(_clean_texts(starts, ends), docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean.select(*docs.columns)
