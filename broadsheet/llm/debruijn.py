"""Substring dedup: repeated runs of words, on a compacted De Bruijn graph.

Each window of 20 words is an edge of the graph, from the node of its first 19 words to that of
its last 19. Only edges that can repeat become part of it:

1. Consecutive edges of a text under one minimizer are one row, named by its first and its last
   node; as it has at most 15 edges, these two nodes cover all its words. Rows whose minimizer
   occurs once in the corpus cannot repeat. Equal rows are compacted into one, with the place of
   the first. Where different rows share a minimizer, they are opened into edges.
2. The repeated rows and edges give the table of nodes, with in- and out-degree. Joins with it
   link neighbours over nodes of one edge in and one edge out, into paths as long as possible
   at their source: ``compacted``.
3. Every later place of a row or edge is a repeat. Neighbouring ones on one path make a span,
   and the words of each span are compared with those at its source coordinates, by digest.

Steps 1 and 2 go by hash. Where step 3 finds that two spans differ, all is done again with
other hash functions, so what is returned has been compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.repeats import WORDS, merged, run_places, texts_by_id, usable, with_spans
from broadsheet.llm.scratch import free_shuffles, remove, written
from broadsheet.llm.textarrays import Hasher, ragged, signed, text_slices, word_spans

KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
NODE = WORDS.width - 1

# Hash functions to try before spans that differ from their source are left out.
SEEDS = (1, 2, 3)

ROW = ["m", "a", "b", "n"]


def _place() -> Column:
    return F.struct("doc_id", "start")


def _row_batches(seed: int, minimizers_only: bool) -> Callable:
    """Rows of edges under one minimizer: it, first and last node, and place; or only it.
    Start and number of edges are one number, to shuffle less."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(seed)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, _, data, offsets in text_slices(batch.column("text")):
                items, bounds = WORDS.sequence(data, offsets, hasher)
                found = run_places(WORDS, items, bounds, hasher)
                if found is None:
                    continue
                sums, m, at, starts, ends = found
                if minimizers_only:
                    yield pa.RecordBatch.from_arrays([pa.array(signed(m))], names=["m"])
                    continue
                place = (starts - bounds[:-1][at] << 8) | (ends - starts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(signed(m)),
                    pa.array(signed(hasher.spans(sums, starts, starts + NODE))),
                    pa.array(signed(hasher.spans(sums, ends, ends + NODE))),
                    pa.array(ids[first + at]), pa.array(place),
                ], names=["m", "a", "b", "doc_id", "place"])

    return rows


def _with_lists(docs: DataFrame, places: DataFrame, *columns: str) -> DataFrame:
    """``(doc_id, text, places)``: the documents of some places with the list of them."""
    lists = places.groupBy("doc_id").agg(F.collect_list(F.struct(*columns)).alias("places"))
    return usable(docs).join(lists, "doc_id")


def _lists(batch: pa.RecordBatch, first: int, end: int) -> tuple[np.ndarray, ...]:
    """The row of each place in rows of a batch of ``_with_lists``, and its columns."""
    lists = batch.column("places").slice(first, end - first)
    offsets = lists.offsets.to_numpy()
    values = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    columns = [values.field(i).to_numpy(zero_copy_only=False) for i in range(values.type.num_fields)]
    return np.repeat(np.arange(end - first), np.diff(offsets)), *columns


def _edge_batches(seed: int) -> Callable:
    """The edges of opened rows, each with its two nodes."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(seed)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, end, data, offsets in text_slices(batch.column("text")):
                at, start, n, c = _lists(batch, first, end)
                start, n = start.astype(np.int64), n.astype(np.int64)
                items, bounds = WORDS.sequence(data, offsets, hasher)
                fits = start + n + NODE <= np.diff(bounds)[at]
                at, start, n, c = at[fits], start[fits], n[fits], c[fits]
                where = ragged(bounds[at] + start, n)
                sums = hasher.prefix(items)
                yield pa.RecordBatch.from_arrays([
                    pa.array(signed(hasher.spans(sums, where, where + NODE))),
                    pa.array(signed(hasher.spans(sums, where + 1, where + 1 + NODE))),
                    pa.array(np.repeat(ids[first + at], n)),
                    pa.array(ragged(start, n).astype(np.int32)),
                    pa.array(np.repeat(c, n)),
                ], names=["a", "b", "doc_id", "start", "c"])

    return rows


def node_degrees(pieces: DataFrame) -> DataFrame:
    """``(node, ins, outs)``: how many pieces ``(a, b)`` end and start at each node."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return pieces.select(F.col("a").alias("node"), none.alias("ins"), one.alias("outs")).unionByName(
        pieces.select(F.col("b").alias("node"), one.alias("ins"), none.alias("outs"))
    ).groupBy("node").agg(F.sum("ins").alias("ins"), F.sum("outs").alias("outs"))


def compacted(pieces: DataFrame) -> DataFrame:
    """Pieces ``(a, b, doc_id, start, n, ...)``, from node ``a`` to node ``b`` with ``n`` edges
    and the place of their source, with one more column ``path``: where the path of each starts
    in its document. Pieces that follow each other there are on one path if no other piece
    enters or leaves the node between them."""
    through = node_degrees(pieces).where("ins = 1 and outs = 1").select(F.col("node").alias("_node"))
    along = Window.partitionBy("doc_id").orderBy("start", "n")
    before = F.lag(F.col("start") + F.col("n")).over(along)
    linked = F.col("_node").isNotNull() & F.coalesce(before == F.col("start"), F.lit(False))
    return pieces.join(through, F.col("a") == F.col("_node"), "left").withColumn(
        "_begin", F.when(~linked, F.col("start"))).withColumn(
        "path", F.max("_begin").over(along.rowsBetween(Window.unboundedPreceding, 0))
    ).drop("_node", "_begin")


def _repeats(docs: DataFrame, seed: int) -> DataFrame:
    """``(doc_id, start, n, of, at, path)``: rows and edges whose hash occurs earlier, with
    the place of the first, document ``of`` and start ``at``, and its path."""
    spark = docs.sparkSession
    texts = usable(docs)
    # Written first, so that the join below is between two plain shuffles, which adaptive
    # execution can split where a minimizer fills a partition.
    shared = written(texts.mapInArrow(_row_batches(seed, True), "m long").groupBy("m").agg(
        F.count("*").alias("c")).where("c > 1").select("m"), "shared")
    free_shuffles(spark)
    found = written(
        texts.mapInArrow(_row_batches(seed, False), "m long, a long, b long, doc_id long, place long")
        .join(shared, "m").select(
            "m", "a", "b", "doc_id", F.expr("cast(shiftright(place, 8) as int) start"),
            F.expr("cast(place & 255 as int) n")), "rows")
    remove(shared)
    free_shuffles(spark)
    once = written(found.groupBy(*ROW).agg(
        F.min(_place()).alias("first"), F.count("*").alias("c")), "once")
    several = once.groupBy("m").agg(F.count("*").alias("k")).where("k > 1")
    marked = written(once.join(several, "m", "left"), "marked")
    remove(once)
    free_shuffles(spark)
    opened = marked.where("k is not null")
    edges = written(
        _with_lists(docs, opened.select("first.*", "n", "c"), "start", "n", "c").mapInArrow(
            _edge_batches(seed), "a long, b long, doc_id long, start int, c long"), "edges")
    free_shuffles(spark)
    edge = edges.groupBy("a", "b").agg(
        F.min(_place()).alias("first"), F.sum("c").alias("c"), (F.count("*") > 1).alias("met")
    ).where("c > 1")
    pieces = written(marked.where("k is null").select(*ROW, "first.*", F.lit(True).alias("met")).unionByName(
        edge.select(F.lit(None).cast("long").alias("m"), "a", "b", F.lit(1).alias("n"), "first.*", "met")
    ), "pieces")
    paths = written(compacted(pieces), "paths")
    remove(pieces)
    free_shuffles(spark)
    first = _place().alias("first")
    rows = paths.where("m is not null").select(*ROW, first, "path").unionByName(
        opened.where("c > 1").select(*ROW, "first", F.lit(None).cast("int").alias("path")))
    met = paths.where("m is null and met").select("a", "b", first, "path")
    columns = "doc_id", "start", "n", F.col("first.doc_id").alias("of"), F.col("first.start").alias("at"), "path"
    later = _place() != F.col("first")
    repeats = written(found.join(rows, ROW).where(later).select(*columns).unionByName(
        edges.join(met, ["a", "b"]).where(later).withColumn("n", F.lit(1)).select(*columns)), "repeats")
    for table in found, marked, edges, paths:
        remove(table)
    free_shuffles(spark)
    return repeats


def _spans(repeats: DataFrame) -> DataFrame:
    """``(doc_id, start, n, of, at)``: neighbouring repeats whose sources are neighbours on one
    path, as one."""
    along = Window.partitionBy("doc_id").orderBy("start", "of", "at")
    goes_on = (F.lag("of").over(along) == F.col("of")) & F.lag("path").over(along).eqNullSafe(
        F.col("path")) & (F.lag(F.col("start") + F.col("n")).over(along) == F.col("start")) & (
        F.lag(F.col("at") + F.col("n")).over(along) == F.col("at"))
    marked = repeats.withColumn("_new", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1))
    return marked.withColumn(
        "_span", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0))
    ).groupBy("doc_id", "_span").agg(
        F.min("start").alias("start"), F.sum("n").cast("int").alias("n"),
        F.min("of").alias("of"), F.min("at").alias("at")).drop("_span")


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of 128 bits of the words of each span, joined by single spaces."""
    for batch in batches:
        for first, end, data, offsets in text_slices(batch.column("text")):
            at, start, n, of, source = _lists(batch, first, end)
            starts, ends, bounds = word_spans(data, offsets)
            room = np.full(int((ends - starts).sum()) + len(starts), 32, np.uint8)
            begin = np.append(0, np.cumsum(ends - starts + 1))
            room[ragged(begin[:-1], ends - starts)] = data[ragged(starts, ends - starts)]
            last = np.minimum(bounds[at] + start + n + NODE, bounds[at + 1])
            low = begin[np.minimum(bounds[at] + start, last)]
            words = memoryview(room.tobytes())
            digests = b"".join(hashlib.blake2b(words[i:j], digest_size=16).digest()
                               for i, j in zip(low.tolist(), begin[last].tolist()))
            halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (of, source, n, halves[:, 0].copy(), halves[:, 1].copy())],
                names=["of", "at", "n", "d1", "d2"])


def _differing(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``(of, at, n)``: sources of spans that do not all have the words of their source.

    Digests of a source and of its repeats meet in partial aggregates, however many there are."""
    own = spans.select("doc_id", "start", "n", "of", "at")
    source = spans.select("of", "at", "n").distinct().select(
        F.col("of").alias("doc_id"), F.col("at").alias("start"), "n", "of", "at")
    digests = _with_lists(docs, own.unionByName(source), "start", "n", "of", "at").mapInArrow(
        _digest_batches, "of long, at int, n int, d1 long, d2 long")
    return digests.groupBy("of", "at", "n").agg(
        F.min("d1").alias("l1"), F.max("d1").alias("h1"), F.min("d2").alias("l2"), F.max("d2").alias("h2")
    ).where("l1 <> h1 or l2 <> h2").select("of", "at", "n")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``(doc_id, start, n, of, at)``: spans of ``n`` word windows that also start earlier, in a
    document of smaller id, or earlier in the same one: there in document ``of``, at ``at``.

    All spans have been compared with their source. Spans that differ under each hash function,
    as when different texts share an id, are left out."""
    spans = wrong = None
    for seed in SEEDS:
        for table in (spans, wrong):
            if table is not None:
                remove(table)
        repeats = _repeats(docs, seed)
        spans = written(_spans(repeats), "spans")
        remove(repeats)
        free_shuffles(docs.sparkSession)
        wrong = written(_differing(docs, spans), "differing")
        free_shuffles(docs.sparkSession)
        if wrong.isEmpty():
            return spans
    return spans.join(wrong, ["of", "at", "n"], "left_anti")


def _kept_rows(with_text: bool):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, text, *runs in frame.itertuples(index=False, name=None):
                raw = np.frombuffer((text or "").encode(), np.uint8)
                starts, ends, _ = word_spans(raw, np.array([0, len(raw)]))
                keep = np.ones(len(starts), bool)
                for a, b in merged(*runs, WORDS.width, len(starts)):
                    keep[a:b] = False
                data = raw.tobytes()
                kept = b" ".join([data[a:b] for a, b in zip(starts[keep], ends[keep])])
                out.append((doc_id, len(starts), len(starts) - int(keep.sum()),
                            hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in KEPT.split(", ")]).astype(
                {"doc_id": "Int64"})

    return rows


def remove_repeated_words(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256``, and
    ``kept_text``, the words that stay, joined by single spaces.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. A word goes when a
    window of 20 words around it also starts earlier. Windows are judged on the input. A
    null text has no words; texts of fewer than 20 words stay whole, whatever they are; an
    empty table gives an empty result. Rows without an id repeat nothing and stay whole.
    Repeated rows (one id, one text) are one document: each gives the same row.
    """
    spans, _, _ = with_spans(texts_by_id(docs), repeated_windows(docs))
    return spans.mapInPandas(_kept_rows(with_text), KEPT)
