"""Repeated windows of a corpus: what substring and suffix-array dedup have in common.

A text is a sequence of units, words or bytes, and a window is ``width`` units of one
document. Consecutive windows that share one place of their least ``k``-gram hash
(their minimizer) form a run, of at most ``width - k + 1`` windows, no two of them equal. Equal windows have equal minimizers, so a window can only be repeated where
its minimizer is: one small row per run, instead of one per window, finds the candidates,
and everything that follows looks at candidates only. Runs that are equal as a whole are
told apart from runs that only overlap; only the latter are opened.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.scratch import free_shuffles, remove, unused, written
from broadsheet.llm.textarrays import Hasher, signed, sliding_min, text_slices, word_spans
from broadsheet.llm.words import pieces, span_hashes

RUN = "m long, s long, doc_id long, start int, n int"
SPAN = "doc_id long, start int, n int"


@dataclass(frozen=True)
class Unit:
    """What a text is a sequence of, and the length of a window in it."""

    words: bool
    width: int
    k: int

    def sequence(self, data: np.ndarray, offsets: np.ndarray, hasher: Hasher
                 ) -> tuple[np.ndarray, np.ndarray]:
        """The items of a slice of texts, and the offset of each text in them."""
        if not self.words:
            return data, offsets
        starts, ends, bounds = word_spans(data, offsets)
        return span_hashes(pieces(data), starts, ends, hasher.seed), bounds


WORDS = Unit(words=True, width=20, k=6)
BYTES = Unit(words=False, width=100, k=44)


def run_places(unit: Unit, items: np.ndarray, bounds: np.ndarray, hasher: Hasher):
    """``(prefix sums, minimizer, row, start, end)`` of the runs of windows of several texts,
    given one after the other; places are counted from the first item of the first text."""
    lengths = np.diff(bounds)
    windows = np.maximum(lengths - unit.width + 1, 0)
    if not windows.any():
        return None
    sums = hasher.prefix(items)
    grams = hasher.windows(sums, unit.k)
    least = sliding_min(grams, unit.width - unit.k + 1)
    mark = np.zeros(len(items) + 1, np.int8)
    some = windows > 0
    mark[bounds[:-1][some]] += 1
    stops = bounds[:-1][some] + windows[some]
    np.subtract.at(mark, stops, 1)
    valid = np.cumsum(mark[:len(least)], dtype=np.int8) > 0
    begins = np.empty(len(least), bool)
    begins[0] = True
    np.not_equal(least[1:], least[:-1], out=begins[1:])
    begins[1:] |= grams[:len(least) - 1] == least[:-1]
    begins[bounds[:-1][some]] = True
    begins &= valid
    starts = np.flatnonzero(begins)
    rows = np.searchsorted(bounds, starts, "right") - 1
    ends = np.minimum(np.append(starts[1:], len(items)), (bounds[:-1] + windows)[rows])
    return sums, least[starts], rows, starts, ends


def runs_of(unit: Unit, items: np.ndarray, bounds: np.ndarray, hasher: Hasher):
    """``(minimizer, hash of the whole run, row, start, n)`` of the runs of windows of
    several texts, given one after the other."""
    found = run_places(unit, items, bounds, hasher)
    if found is None:
        return None
    sums, least, rows, starts, ends = found
    whole = hasher.spans(sums, starts, ends + unit.width - 1)
    return least, whole, rows, starts - bounds[:-1][rows], ends - starts


def _run_rows(unit: Unit, columns: list[str] | None = None) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, _, data, offsets in text_slices(batch.column("text")):
                items, bounds = unit.sequence(data, offsets, hasher)
                found = runs_of(unit, items, bounds, hasher)
                if found is not None:
                    least, whole, at, start, n = found
                    run = pa.RecordBatch.from_arrays([
                        pa.array(signed(least)), pa.array(signed(whole)),
                        pa.array(ids[first + at]), pa.array(start.astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                    ], names=["m", "s", "doc_id", "start", "n"])
                    yield run.select(columns) if columns else run

    return rows


def texts_by_id(docs: DataFrame) -> DataFrame:
    """Id and text of each document, and no other column."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def usable(docs: DataFrame) -> DataFrame:
    """Ids and texts of the documents that can hold a repeat: those with both."""
    return texts_by_id(docs).where("doc_id is not null and text is not null")


def repeated_runs(docs: DataFrame, unit: Unit) -> tuple[DataFrame, DataFrame]:
    """The runs that may hold a repeated window, as two tables.

    ``again``, ``(doc_id, start, n)``: runs that are equal, as a whole, to an earlier one;
    all their windows are repeats. ``open``, ``(m, doc_id, start, n, k)``: the first of each
    set of equal runs, where ``k`` > 1 different runs share the minimizer ``m``. Runs that
    are in neither table hold no repeat.

    Counting is by hash and pre-aggregated where the text is read.
    """
    texts = usable(docs)
    # Written first, so that the join below is between two plain shuffles, which adaptive
    # execution can split where a minimizer fills a partition.
    shared = written(texts.mapInArrow(_run_rows(unit, ["m"]), "m long").groupBy("m").agg(
        F.count("*").alias("c")).where("c > 1").select("m"), "shared")
    free_shuffles(docs.sparkSession)
    found = written(texts.mapInArrow(_run_rows(unit), RUN).join(shared, "m"), "runs")
    free_shuffles(docs.sparkSession)
    place = F.struct("doc_id", "start")
    paths = written(found.groupBy("m", "s", "n").agg(
        F.min(place).alias("first"), F.count("*").alias("c")), "paths")
    equal = paths.where("c > 1").select("m", "s", "first")
    again = written(
        found.join(equal, ["m", "s"]).where(place != F.col("first")).select(
            "doc_id", "start", "n"), "again")
    remove(found)
    remove(shared)
    branching = paths.groupBy("m").agg(F.count("*").alias("k")).where("k > 1")
    opened = written(paths.join(branching, "m").select("m", "first.*", "n", "k"), "open")
    remove(paths)
    free_shuffles(docs.sparkSession)
    return again, opened


def open_texts(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """``(doc_id, text, runs)``: the documents of some runs with the list of them."""
    lists = runs.groupBy("doc_id").agg(F.collect_list(F.struct("m", "start", "n")).alias("runs"))
    return usable(docs).join(lists, "doc_id")


def run_lists(batch: pa.RecordBatch, first: int, end: int):
    """``(row, m, start, n)`` of all runs in rows of a batch of ``open_texts``."""
    lists = batch.column("runs").slice(first, end - first)
    offsets = lists.offsets.to_numpy()
    values = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    rows = np.repeat(np.arange(end - first), np.diff(offsets))
    m, start, n = (values.field(i).to_numpy(zero_copy_only=False) for i in range(3))
    return rows, m, start.astype(np.int64), n.astype(np.int64)


def with_spans(docs: DataFrame, windows: DataFrame) -> tuple[DataFrame, str, str]:
    """All documents with two more columns at the end, and the names of these: the starts and
    ends of the runs of windows to remove, by start; null where there are none."""
    doc, starts, ends = unused(docs, "doc", "starts", "ends")
    run = F.struct("start", (F.col("start") + F.col("n")).alias("end"))
    spans = windows.groupBy(F.col("doc_id").alias(doc)).agg(
        F.array_sort(F.collect_list(run)).alias("runs")
    ).select(doc, F.col("runs.start").alias(starts), F.col("runs.end").alias(ends))
    joined = docs.join(spans, docs["doc_id"].cast("long") == F.col(doc), "left").drop(doc)
    return joined, starts, ends


def merged(starts, ends, width: int, length: int) -> np.ndarray:
    """Units covered by runs of windows, as disjoint ranges in order: rows (start, end)."""
    if starts is None or not len(starts):
        return np.zeros((0, 2), np.int64)
    starts = np.asarray(starts, np.int64)
    ends = np.minimum(np.maximum.accumulate(np.asarray(ends, np.int64) + width - 1), length)
    first = np.concatenate(([True], starts[1:] > ends[:-1]))
    out = np.stack([starts[first], ends[np.append(first[1:], True)]], 1)
    return out[out[:, 0] < out[:, 1]]
